import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import no_docs, odd_docs, read_docs  # noqa: F401
from tessera.llm import personal_data as P
from tessera.llm import queries

PATTERNS = [  # the definitions as they stand
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda s: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda s: 14 <= len(re.sub(r"\D", "", s)) <= 19 and _luhn(re.sub(r"\D", "", s))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda s: 10 <= len(re.sub(r"\D", "", s)) <= 15),
]


def _luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def _plain(text):
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(PATTERNS) for m in p.finditer(text) if ok(m.group())]
    return [(PATTERNS[k][0], s, e) for s, k, e in sorted(found)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1234590.@-+% ()", max_size=60))
def test_base_spans_are_the_definitions(text):
    assert [x[:3] for x in P.find_spans(text) if x[0] in P.BASE_KINDS] == _plain(text)


def test_query_matches_definitions(spark):
    from conftest import SF_SMALL

    text_of = {r["doc_id"]: r["text"] for r in queries.table(spark, SF_SMALL, "documents").collect()}
    rows = queries.op8_personal_data(spark, SF_SMALL).collect()
    assert len(rows) == len(text_of)
    for r in rows:
        spans = _plain(text_of[r["doc_id"]])
        told = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.BASE_KINDS] == [sum(x[0] == k for x in spans) for k in P.BASE_KINDS]


def test_checksums_and_context():
    kinds = lambda t: [x[0] for x in P.find_spans(t)]
    assert kinds("pay DE89 3704 0044 0532 0130 00 NOW OR NEVER") == ["iban"]
    assert kinds("pay DE89 3704 0044 0532 0130 01") == []
    assert kinds("his SSN is 123-45-6789.") == ["national"]
    assert kinds("part 123-45-6789.") == []
    assert kinds("4111 1111 1111 1111") == ["card"]
    assert kinds("4111 1111 1111 1112") == []
    assert P.find_spans("call +1 (212) 555-0100")[0][3] > P.find_spans("ring +1 (212) 555-0100")[0][3]


def test_long_runs_take_linear_time():
    import time

    start = time.time()
    for c in ("a", "1", "1 ", "+1", "1.", "A", "@"):
        P.find_spans(c * 200_000)
    assert time.time() - start < 20


def test_odd_cases_and_mask(read_docs, no_docs, spark):
    assert P.digest(P.detect(read_docs)).count() == read_docs.count()
    assert P.digest(P.detect(no_docs)).count() == 0
    df = spark.createDataFrame([(1, "write a@b.cd or +1 212 555 0100!", 9), (2, None, None), (3, "", 0)], "doc_id long, text string, n_chars long")
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in P.mask(df).collect()} == {1: ("write [EMAIL] or [PHONE]!", 25), 2: (None, None), 3: ("", 0)}
    assert P.mask(read_docs).columns == read_docs.columns


def test_iban_before_other_words():
    for text, masked in [
        ("IBAN DE89370400440532013000 Please pay", "IBAN [IBAN] Please pay"),
        ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "IBAN [IBAN] BIC COBADEFFXXX"),
        ("account GB82 WEST 1234 5698 7654 32 Thanks", "account [IBAN] Thanks"),
        ("SEND THE SUM TO DE89 3704 0044 0532 0130 00 BEFORE THE END OF THE MONTH", "SEND THE SUM TO [IBAN] BEFORE THE END OF THE MONTH"),
        ("REF AB12 3456 7890 DE89 3704 0044 0532 0130 00.", "REF AB12 3456 7890 [IBAN]."),
        ("DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32", "[IBAN] [IBAN]"),
        ("NO9386011117947 Og NO9386011117947x", "[IBAN] Og NO9386011117947x"),
        ("DE89 3704 0044 0532 0130 01 Please", "DE89 3704 0044 0532 0130 01 Please"),
    ]:
        assert P._masked(text) == masked


def test_many_country_codes_take_linear_time():
    import time

    start = time.time()
    P.find_spans("AB12 " * 40_000)
    assert time.time() - start < 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["DE89370400440532013000", "+49 370 400 4405", "ssn 123-45-6789", "4111 1111 1111 1111", " ", "x@y.zz", "1.2.3.4", ",", "GB82 WEST 1234 5698 7654 32"]), max_size=14).map("".join))
def test_added_spans_never_overlap_base_ones(text):
    """The sweep drops what a comparison of all pairs drops."""
    base = [(s, e) for _, s, e in _plain(text)]
    extra = [x for x in P._proposals(text) if x[0] not in P.BASE_KINDS]
    told = {(k, s, e) for k, s, e, _ in P.find_spans(text) if k not in P.BASE_KINDS}
    for kind, start, end, confirmed in extra:
        clear = not any(s < end and start < e for s, e in base)
        assert ((kind, start, end) in told) == (clear and (confirmed or bool(P._CONTEXT[kind].search(text[max(0, start - 40):start]) or P._CONTEXT[kind].search(text[end:end + 40]))))


def test_many_spans_of_all_kinds_take_linear_time():
    import time

    start = time.time()
    assert len(P.find_spans("DE89 3704 0044 0532 0130 00, a@b.cd, " * 130_000)) == 260_000  # 5 MB
    assert time.time() - start < 40
