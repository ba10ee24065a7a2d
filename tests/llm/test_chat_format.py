import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tessera.llm import chat_format, queries


def _expected(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _got(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_query_reads_back_every_turn(spark):
    from conftest import SF_SMALL

    rows = [tuple(r) for r in queries.table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert _got(queries.op4_chat_format(spark, SF_SMALL)) == _expected(rows + queries.CONTROL_TURNS)


ODD = [
    (1, 0, "we>ird\nrole é </turn>", "a<turn x>\\n</turn>\n<\\/turn <\\\\turn"), (1, None, None, None), (1, 0, "user", "tie"), (1, 0, "user", "tie"),
    (2, 1, "assistant", ""), (2, 2, "assistant", "\U0001f600</turn>\n"), (2, 3, "user", "<"), (None, 1, "assistant", "no id"), (None, 2, "user", "$1 \\1"),
    (3, 0, "user", "only"), (4, 0, "assistant", "</turn>\n" * 50), (5, 0, "assistant", "x" * 200_000), (5, 1, "assistant", "\n"),
]


def test_odd_cases(spark):
    df = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string").withColumn("example", F.lit(1))
    found = chat_format.examples(df)
    assert _got(chat_format.digest(found)) == _expected(ODD)
    for r in found.collect():
        assert len(r["formatted"]) >= r["loss_start"] + r["loss_length"]
    assert chat_format.examples(df.limit(0)).count() == 0


def test_one_example_for_each_reply(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (1, 4, "user", "s")]
    found = chat_format.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("example").collect()
    spans = [r["formatted"][r["loss_start"]:r["loss_start"] + r["loss_length"]] for r in found]
    assert spans == ["a", "b", ""]
    assert found[0]["formatted"] == "<turn user>q</turn>\n<turn assistant>a</turn>\n"
    assert found[1]["formatted"].startswith(found[0]["formatted"])


def test_no_python_in_the_plan(spark):
    from conftest import SF_SMALL

    plan = queries.op4_chat_format(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
