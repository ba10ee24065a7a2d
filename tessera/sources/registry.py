"""Dataset registry (S6) and training mixtures."""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .filesystems import opened, qualified, reaches

REGISTRY_SCHEMA = "type string, name string, data_dir string, num_files long, parquet_info_path string, num_total_samples long"


def _entry(table: dict, key: str, what: str):
    try:
        return table[key]
    except KeyError:
        raise ValueError(f"{what} {key!r} is not registered; known: {', '.join(sorted(table)) or 'none'}") from None


@dataclass
class Registry:
    """type → name → info, and type → row-to-sequence transform (U4)."""

    info: dict[str, dict[str, dict]] = field(default_factory=dict)
    handlers: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    def register(self, dataset_type: str, name: str, handler: Callable[[DataFrame], DataFrame] | None = None, **info):
        self.info.setdefault(dataset_type, {})[name] = dict(info)
        if handler is not None:
            self.handlers[dataset_type] = handler

    def get_dataset_class(self, dataset_type: str) -> Callable[[DataFrame], DataFrame]:
        """The row-to-sequence transform of a type (U4)."""
        return _entry(self.handlers, dataset_type, "handler of type")

    def get_dataset_info(self, dataset_type: str, name: str | None = None) -> dict:
        """All datasets of a type, or the one called ``name``."""
        of_type = _entry(self.info, dataset_type, "dataset type")
        return _entry(of_type, name, f"{dataset_type} dataset") if name else of_type

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (t, n, i.get("data_dir"), i.get("num_files"), i.get("parquet_info_path"), i.get("num_total_samples"))
            for t, by_name in self.info.items()
            for n, i in by_name.items()
        ]
        return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def lookup(registry_df: DataFrame, dataset_type: str, name: str | None = None) -> DataFrame:
    """S6 as a DataFrame filter; raises ``ValueError`` when nothing matches."""
    out = registry_df.filter(F.col("type") == dataset_type)
    if name:
        out = out.filter(F.col("name") == name)
    if out.limit(1).count() == 0:
        raise ValueError(f"no registered dataset matches {dataset_type!r}, {name!r}")
    return out


def _natural(path: str) -> list:
    """Sort key in which ``shard_id=2`` comes before ``shard_id=10``."""
    return [(0, int(part), "") if part.isdigit() else (1, 0, part) for part in re.split(r"(\d+)", path)]


def first_files(spark: SparkSession, path: str, n: int) -> list[str]:
    """The first ``n`` data files of a dataset, by path with the numbers in it by
    value.

    Folders are opened in that order, and only as far as it takes; a dataset of
    very many folders is not listed whole.  (A folder's key, with its slash, comes
    before those of all files in it.)  Globs, and stores that only Spark's readers
    reach, are listed by Spark."""
    import pyarrow.fs as pafs

    base = qualified(spark, path)
    if n < 0 or not reaches(base) or re.search(r"[][{}*?\\]", base):
        return sorted(spark.read.parquet(path).inputFiles(), key=_natural)[:n]
    fs, root = opened(base)

    def entry(info) -> tuple[list, str, bool]:
        folder = info.type == pafs.FileType.Directory
        return _natural(info.path + "/" * folder), info.path, folder

    ahead, files = [entry(fs.get_file_info(root))], []
    while ahead and len(files) < n:
        _, at, folder = heapq.heappop(ahead)
        if not folder:
            files.append(base + at[len(root):])
            continue
        below = [i for i in fs.get_file_info(pafs.FileSelector(at)) if not _hidden(i.base_name)]
        for e in map(entry, below):
            heapq.heappush(ahead, e)
    return files


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def load_mixture(spark: SparkSession, registry: Registry, config: dict) -> DataFrame:
    """For each dataset type in ``config`` (``dataset_names``, ``num_used_data``,
    ``weight``), read the first N parquet files of each named dataset (by path,
    numbers in it by value), tag rows with ``dataset``/``weight`` and union them by name.

    The weight is carried as a column; the sampler that applies it is external.
    """
    parts = []
    for dataset_type, cfg in config.items():
        names = cfg.get("dataset_names", [])
        used = cfg.get("num_used_data", [None] * len(names))
        if len(used) != len(names):
            raise ValueError(f"{dataset_type}: {len(names)} dataset names, but {len(used)} entries in num_used_data")
        weight = float(cfg.get("weight", 1.0))
        for name, n_files in zip(names, used, strict=True):
            info = registry.get_dataset_info(dataset_type, name)
            files = [info["data_dir"]] if n_files is None else first_files(spark, info["data_dir"], int(n_files))
            reader = spark.read
            if len(files) != 1 or not files[0].rstrip("/").endswith(info["data_dir"].rstrip("/")):
                reader = reader.option("basePath", info["data_dir"])  # keep partition columns of a folder
            df = reader.parquet(*files)
            parts.append(df.withColumn("dataset", F.lit(name)).withColumn("weight", F.lit(weight)))
    if not parts:
        raise ValueError("empty mixture")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
