"""Session factory and the two ways this library cuts lineage: a reliable checkpoint and a staged table.

Both live in the shared folder named by ``spark.checkpoint.dir``; a private folder is made only where that
setting is absent (tests and local runs). Nothing here uses executor-local storage, so a lost executor costs
a re-read and not the query.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def make_session(app: str = "kilovela", cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Local session with the settings every operator assumes: UTC, ANSI, AQE with skew handling."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share: the session's ``spark.checkpoint.dir``, else the checkpoint directory already set, else, in local
    mode only, a fresh temporary one that goes when Python ends. On a cluster without that setting it raises: a folder of
    one machine would be written in parts by several."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="kilovela_")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def stage(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back: lineage ends there, statistics are
    known to the planner, and columns stay prunable. The folder goes with the driver's JVM."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kv_{name}_{uuid.uuid4().hex}"
    df.write.parquet(path)
    _passing(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, keys: list[str], name: str = "t") -> DataFrame:
    """As ``stage``, written in buckets of the keys: whatever groups by these keys (and more) afterwards needs no shuffle."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, full = f"{shared_dir(spark)}/kv_{name}_{uuid.uuid4().hex}", f"kv_{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", path).format("parquet").saveAsTable(full)
    _passing(spark, path)
    return spark.table(full)


def _passing(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


MAX_BYTES = 48 << 20


def fits_broadcast(df: DataFrame, max_rows: int = 200_000, max_bytes: int = MAX_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes of values, measured by reading no more than that many rows."""
    fixed, size = 0, F.lit(0).cast("long")
    for c, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        fixed += 8
    r = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return r["n"] <= max_rows and r["b"] + fixed * r["n"] <= max_bytes


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", salt_of: str | None = None, max_rows: int = 200_000, salts: int = 16) -> DataFrame:
    """Join a large, possibly skewed side with a side that is usually small.

    Up to ``max_rows`` counted rows and ``MAX_BYTES`` measured bytes the small side is broadcast. Beyond that both sides are shuffled; if
    ``salt_of`` names a column of ``big``, the small side is repeated ``salts`` times and the large side spread by
    a hash of that column, so that one hot key is met by ``salts`` tasks. Results are the same in every case.
    """
    if fits_broadcast(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    if salt_of is None:
        return big.join(small, on, how)
    big = big.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(salts)).cast("int"))
    small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.join(small, [*on, "_salt"], how).drop("_salt")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per context, unless they find it by PYTHONPATH or working directory."""
    sc, root = spark.sparkContext, Path(__file__).resolve().parent.parent
    reach = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if getattr(sc, "_kilovela_shipped", False) or str(root) in {str(Path(p).resolve()) for p in reach if p}:
        return
    folder = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    if not os.path.isdir(folder):  # an object store: the archive is made here and handed to Spark, which serves it to the workers
        folder = tempfile.mkdtemp(prefix="kilovela_")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/kilovela_{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((root / "kilovela").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(path)
    sc._kilovela_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
