"""Tables written to the shared folder, so that later steps don't recompute them, and code for the executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from threadlens.session import checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table below ``spark.checkpoint.dir``: lineage is cut and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/threadlens-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per Spark context); its functions run there by import."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parent.parent
    if getattr(sc, "_corpus_shipped", False) or not root.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="corpus-code-")) / f"{root.name}-code.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._corpus_shipped = True
