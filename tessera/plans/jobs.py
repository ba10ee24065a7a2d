"""End-to-end jobs: source records → prepared datasets → splits → info docs.

    python -m tessera.plans.jobs convert-a --input recs.jsonl --image-dir imgs --output out_a
    python -m tessera.plans.jobs convert-b --input recs.jsonl --image-root data --output out_b
    python -m tessera.plans.jobs split --input out_b/train --output out_b/split
    python -m tessera.plans.jobs parquet-info --input out_b/split/split=train --output out_b/train_info
    python -m tessera.plans.jobs sequences --input out_a --output seq_a
    python -m tessera.plans.jobs token-batches --input out_b/split/split=train --output batches

Conversions read their records once: the images a record names are read where
the record is (``ImageFiles``), its status is written with it, and the rows that
are ``ok`` follow from there, so a rejected record's bytes go nowhere and the
counts are those of the rows written.  What lies in between is parquet below the
session's shared ``spark.checkpoint.dir`` (never ``localCheckpoint``), so a lost
executor costs a recompute of its own tasks only; it is removed when the job is
done.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest as I
from ..operators import sequence as S
from ..operators import tokens as TK
from ..operators.images import image_index
from ..operators.order import exact_split, shuffle_key, train_test_split
from ..session import ensure_checkpoint_dir, remove_folder
from ..sinks import files as K
from ..sinks import shards as SH
from ..sources.footers import dataset_footers
from ..sources.filesystems import qualified
from ..sources.images import ImageFiles, read_images
from ..sources.records import read_cot, read_pairs, read_task_options


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder below the shared checkpoint folder, removed at the end."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-staging/{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        remove_folder(spark, folder)


def staged(spark: SparkSession, df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` once as parquet and read it back: what follows scans the
    columnar copy with column pruning.  The written table also cuts the lineage."""
    df.write.mode("overwrite").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def parent(spark: SparkSession, path: str) -> str:
    """The folder a file, folder or glob lies in, as a URI."""
    return qualified(spark, path).rsplit("/", 1)[0]


REPORT = "status string, n long"


def _report(spark: SparkSession, with_status: DataFrame, statuses: list[str]) -> DataFrame:
    """A1 / A2: rows by status, as a table that outlives what it was counted from
    (a count for each status; no rows at all give zeros for those named)."""
    counts = {r["status"]: r["n"] for r in I.ingest_report(with_status.select("status")).collect()}  # a handful of statuses
    return spark.createDataFrame(list((dict.fromkeys(statuses, 0) | counts).items()), REPORT)


def _rows_with_status(spark: SparkSession, input_path: str, root: str, folder: str, layout: str) -> DataFrame:
    """Every record with its status and, as far as read, its images."""
    records = read_cot(spark, input_path)
    if ImageFiles.reaches(spark, root):
        files = ImageFiles(spark, root)
        with_status = I.with_files_a(records, files) if layout == "a" else I.with_files_b(records, files)
        return staged(spark, with_status, f"{folder}/status")
    # a store that only Spark's readers reach: every file is listed, and joined by path
    records = staged(spark, records, f"{folder}/records")
    images = read_images(spark, root)
    keyed = I.with_record_key(records)
    joined = I.join_files(I.kept_image_refs(keyed, dotall=layout == "b", key=I.RECORD), images.select("path", "content"), "left",
                          I.hot_image_paths(records, images=images))
    found = I.task_images(joined).select(I.RECORD, F.expr("transform(_imgs, _x -> _x.b)").alias("_found"))
    return staged(spark, I.status_of_found(keyed.join(found, I.RECORD, "left").drop(I.RECORD), layout), f"{folder}/status")


def convert_layout_a(spark: SparkSession, input_path: str, output: str, image_dir: str | None = None,
                     samples_per_file: int = 100, on_missing: str = "skip") -> tuple[DataFrame, DataFrame]:
    """Records → layout A shards of ``samples_per_file`` rows + manifest.

    Returns (status counts, manifest).  Shards follow task order.  Without
    ``image_dir``, paths are relative to the input's folder.  No ok record gives
    no shard, counts of zero and an empty manifest.
    """
    with scratch(spark) as folder:
        with_status = _rows_with_status(spark, input_path, image_dir or parent(spark, input_path), folder, "a")
        report = _report(spark, with_status, [I.STATUS_OK, I.STATUS_MISMATCH, I.STATUS_RENDER, I.STATUS_OTHER])
        rows = I.ok_layout_a(with_status, on_missing)
        # task order: the number inside ``id`` first, the id itself as tiebreak
        order = [F.expr("try_cast(substring(id, 6) AS BIGINT)"), "id"]
        manifest = SH.write_shards(staged(spark, rows, f"{folder}/rows"), output, order, samples_per_file, materialize=False)
    return report, manifest


def convert_layout_b(spark: SparkSession, input_path: str, image_root: str, output: str) -> DataFrame:
    """Records → one layout-B dataset at ``output/train`` + ``output/train_info``
    and the counts by status at ``output/train_status``."""
    with scratch(spark) as folder:
        with_status = _rows_with_status(spark, input_path, image_root, folder, "b")
        K.write_json_doc(_report(spark, with_status, [I.STATUS_OK, I.STATUS_NO_IMAGE, I.STATUS_IMAGE_ERROR]), f"{output}/train_status")
        rows = I.ok_layout_b(with_status, read_task_options(spark, image_root))
        K.write_pairs(rows, f"{output}/train")
    info = K.dataset_info(spark.read.schema(rows.schema).parquet(f"{output}/train"), f"{output}/train")
    K.write_json_doc(info, f"{output}/train_info")
    return info


def split_dataset(spark: SparkSession, input_path: str, output: str, ratio: float = 0.9, seed: int = 42,
                  key: str | None = None, ordered: bool = False) -> DataFrame:
    """90:10 split of a prepared dataset, written once as ``split=train`` /
    ``split=test`` folders, plus per-split info docs.

    Rows are not moved: the cut is found among the keys, and each task writes its
    rows to their side.  With ``ordered`` the files hold the rows in the order of
    the seeded permutation, which shuffles them (training reads them in an order of
    its own for each epoch either way)."""
    df = read_pairs(spark, input_path)
    key = key or ("task_id" if "task_id" in df.columns else "id")
    if ordered:
        n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        out = train_test_split(df, key, ratio, seed).repartitionByRange(n, "split", "split_idx").sortWithinPartitions("split", "split_idx").drop("perm_idx", "split_idx")
    else:
        out = exact_split(df, key, ratio, seed)
    out.write.mode("overwrite").partitionBy("split").parquet(output)
    written = read_pairs(spark, output)
    counts = written.groupBy("split").agg(F.count(F.lit(1)).alias("num_samples")).select(
        "split", "num_samples", F.concat(F.lit(f"{output}/split="), F.col("split")).alias("file_path"))
    K.write_json_doc(counts, f"{output}_info")
    return counts


def _unified(df: DataFrame) -> DataFrame:
    """A prepared dataset of either layout in the unified shape."""
    if "id" in df.columns:
        return S.unify_layout_a(df)
    return S.unify_layout_b(df)


def write_sequences(spark: SparkSession, input_path: str, output: str) -> DataFrame:
    """Prepared rows → one labelled sequence per accepted row (U4), plus the
    count of rejected rows by reason (N5) at ``output_reasons``."""
    unified = _unified(read_pairs(spark, input_path))
    S.sequence_plan(unified).write.mode("overwrite").parquet(output)
    reasons = S.reject_counts(unified)
    K.write_json_doc(reasons, f"{output}_reasons")
    return reasons


def write_token_batches(spark: SparkSession, input_path: str, output: str, batch_size: int = 4,
                        max_length: int = TK.MAX_LENGTH, max_tokens: int | None = None,
                        tokenize: Callable[[Column], Column] | None = None, epoch: int | None = None,
                        seed: int = 42) -> DataFrame:
    """Layout-B rows → shifted, padded next-token batches.

    ``tokenize`` maps text to ids (``TK.file_tokenizer`` loads a vocabulary file,
    ``TK.pandas_tokenizer`` wraps any encoder, U3);
    with ``epoch`` the rows are batched in that epoch's shuffled order (O2).

    Rows over ``max_tokens`` are written to ``output_over_budget`` instead of
    being lost.  Returns the batch count and padding totals.
    """
    df = read_pairs(spark, input_path)
    text = df.select("task_id", TK.training_text(F.col("question_interleave"), F.col("solution_interleave")).alias("text"))
    ids_of = tokenize or (lambda c: TK.hash_tokenize(c, max_length=max_length))
    toks = text.withColumn("tokens", ids_of(F.col("text")))
    if max_tokens is not None:
        toks, over = TK.token_budget_filter(toks, "tokens", max_tokens)
        over.select("task_id", F.size("tokens").alias("n_tokens")).write.mode("overwrite").parquet(f"{output}_over_budget")
    ids, labels = TK.next_token_pairs(F.col("tokens"))
    pairs = toks.select("task_id", ids.alias("input_ids"), labels.alias("labels"))
    order = ["task_id"]
    if epoch is not None:
        pairs = pairs.withColumn("_place", shuffle_key(F.col("task_id"), seed, epoch))
        order = ["_place", "task_id"]
    batches = TK.pad_batches(pairs, order, batch_size, materialize=True)
    batches.select("batch_id", "row_in_batch", "task_id", "input_ids", "labels", "attention_mask").write.mode(
        "overwrite").parquet(output)
    return read_pairs(spark, output).agg(
        F.countDistinct("batch_id").alias("num_batches"), F.count(F.lit(1)).alias("num_rows"))


def parquet_info(spark: SparkSession, input_path: str, output: str | None = None) -> DataFrame:
    """Row groups and rows per file of a parquet dataset (read on executors)."""
    doc = K.row_group_info(dataset_footers(spark, input_path))
    if output:
        K.write_json_doc(doc, output)
    return doc


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("convert-a")
    a.add_argument("--input", required=True)
    a.add_argument("--output", required=True)
    a.add_argument("--image-dir")
    a.add_argument("--samples-per-file", type=int, default=100)
    a.add_argument("--on-missing", default="skip", choices=["skip", "drop_row", "compact"])
    b = sub.add_parser("convert-b")
    b.add_argument("--input", required=True)
    b.add_argument("--image-root", required=True)
    b.add_argument("--output", required=True)
    s = sub.add_parser("split")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--ratio", type=float, default=0.9)
    s.add_argument("--seed", type=int, default=42)
    s.add_argument("--ordered", action="store_true")
    p = sub.add_parser("parquet-info")
    p.add_argument("--input", required=True)
    p.add_argument("--output")
    q = sub.add_parser("sequences")
    q.add_argument("--input", required=True)
    q.add_argument("--output", required=True)
    t = sub.add_parser("token-batches")
    t.add_argument("--input", required=True)
    t.add_argument("--output", required=True)
    t.add_argument("--batch-size", type=int, default=4)
    t.add_argument("--max-length", type=int, default=TK.MAX_LENGTH)
    t.add_argument("--max-tokens", type=int)
    t.add_argument("--epoch", type=int)
    t.add_argument("--tokenizer", help="vocabulary file on every executor: tokenizers JSON or sentencepiece model")
    args = ap.parse_args(argv)
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("tessera").getOrCreate()  # the submitted master
    if args.cmd == "convert-a":
        report, manifest = convert_layout_a(spark, args.input, args.output, args.image_dir, args.samples_per_file,
                                            args.on_missing)
        report.show()
        manifest.orderBy("shard_id").show(truncate=False)
    elif args.cmd == "convert-b":
        convert_layout_b(spark, args.input, args.image_root, args.output).show(truncate=False)
    elif args.cmd == "split":
        split_dataset(spark, args.input, args.output, args.ratio, args.seed, ordered=args.ordered).show(truncate=False)
    elif args.cmd == "sequences":
        write_sequences(spark, args.input, args.output).show(truncate=False)
    elif args.cmd == "token-batches":
        tokenize = TK.file_tokenizer(args.tokenizer, args.max_length) if args.tokenizer else None
        write_token_batches(spark, args.input, args.output, args.batch_size, args.max_length,
                            args.max_tokens, tokenize, args.epoch).show(truncate=False)
    else:
        parquet_info(spark, args.input, args.output).show(truncate=False)


if __name__ == "__main__":
    main()
