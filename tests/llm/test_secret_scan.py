import hashlib
import math
import re
import time
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import no_docs, odd_docs, read_docs  # noqa: F401
from tessera.llm import queries
from tessera.llm import secret_scan as S

PATTERNS = [  # the definitions as they stand
    ("assign", re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def _plain(text):
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(PATTERNS) for m in p.finditer(text) if ok(m)]
    return [(PATTERNS[k][0], s, e) for s, k, e in sorted(found)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["token", "Api_Key", "apikey", "paſſword", "passwd", "toKen", "=", ":", " ", '"', "'", "abc123", "AKIA", "ABCDEFGH12345678", "0af3", "é", "\n"]), max_size=25).map("".join))
def test_base_spans_are_the_definitions(text):
    assert S.base_spans(text) == _plain(text)
    assert [x[:3] for x in S.find_spans(text) if x[0] in S.BASE_KINDS] == _plain(text)


def _entropy(s):
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdefABC0123456789+/", min_size=20, max_size=60), st.sampled_from(S.CLASSES))
def test_sliding_counts_equal_fresh_counts(run, kind):
    got = dict(S.windows(run, kind))
    for i in range(len(run) - kind.width + 1):
        w = run[i:i + kind.width]
        passes = _entropy(w) >= kind.bits and sum(map(str.isdigit, w)) >= kind.digits and sum(map(str.isalpha, w)) >= kind.letters
        if abs(_entropy(w) - kind.bits) > 1e-6:
            assert (i in got) == passes
        if i in got:
            assert abs(got[i] - _entropy(w)) < 1e-6


def test_entropy_spans_and_allow_list():
    kinds = lambda t: [x[0] for x in S.find_spans(t)]
    secret = "xK9fQ2mZr7Tb4WvLp8Yc"
    assert kinds(f"the value {secret} was leaked") == ["alnum"]
    assert kinds("key 9F86D081884C7D659A2FEAA0C55AD015 here") == ["digits16"]
    assert kinds("aws wJalrXUtnFEMI/K7MDENG/bPxRfiCY4zQ9tLmN0 end") == ["base64"]
    assert kinds(f'token = "{secret}"') == ["assign"]  # not told twice
    assert kinds("9f86d081884c7d659a2feaa0c55ad015") == ["hex"]
    for benign in [
        "123E4567-E89B-42D3-A456-426614174000",  # an id, not a key
        f"sha256:{secret}{secret}", f"integrity {secret}abc", f"sha512-{secret}{secret}",
        "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
        "some/long/path/to/a/file/2024/chapter_12-draft", "ShThatIonTheReadingWritingOfLongWords", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz1111",
        "=" * 60, "-" * 80, "E3B0C44298FC1C149AFBF4C8996FB92427AE41E4649B934CA495991B7852B855",
    ]:
        assert kinds(benign) == [], benign
    assert S.find_spans(f"{secret}1x", frozenset({f"{secret}1x".lower()})) == []


def test_spans_follow_the_windows():
    secret = "xK9fQ2mZr7Tb4WvLp8Yc"
    (kind, start, end, bits), = S.find_spans("z" * 40 + secret + "z" * 40)
    assert kind == "alnum" and start < 40 + len(secret) / 2 < end and end - start < 60 and bits > 3.6


def test_long_runs_take_linear_time():
    start = time.time()
    for c in ("a", "1", "token", "token ", "AKIA", "aB3+", "secret=", "0af", "é"):
        S.find_spans(c * 100_000)
    assert time.time() - start < 30


def test_query_matches_definitions(spark):
    from conftest import SF_MID

    text_of = {r["doc_id"]: r["text"] for r in queries.table(spark, SF_MID, "documents").collect()}
    rows = queries.op12_secret_scan(spark, SF_MID).collect()
    assert len(rows) == len(text_of)
    for r in rows:
        text = text_of[r["doc_id"]] or ""
        spans = _plain(text)
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in S.BASE_KINDS] == [sum(x[0] == k for x in spans) for k in S.BASE_KINDS]
        assert r["spans"] == ",".join(f"{k}:{s}:{e}" for k, s, e, _ in S.find_spans(text))


def test_odd_cases(read_docs, no_docs):  # noqa: F811
    assert S.digest(S.detect(read_docs)).count() == read_docs.count()
    assert S.digest(S.detect(no_docs)).count() == 0
    assert {r["spans"] for r in S.digest(S.detect(read_docs.filter("text is null"))).collect()} == {""}
