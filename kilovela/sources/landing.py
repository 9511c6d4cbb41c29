"""Edge input and output: JSON lines with a given schema, date-chunked readers, atomic publication, guards."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Iterator
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

TRANSIENT = (429, 500, 502, 503, 504)


def read_json(spark: SparkSession, path: str, schema: str, min_parallel: int = 0) -> DataFrame:
    """JSON lines, plain or gzip (by suffix), without an inference pass. gzip files cannot be split; ``min_parallel`` spreads
    their rows after the read."""
    df = spark.read.schema(schema).json(path)
    return df.repartition(min_parallel) if min_parallel else df


def lineage(df: DataFrame) -> DataFrame:
    """Adds file name and path, load time and day. Call right after a file read."""
    p = F.col("_metadata.file_path")
    return df.select("*", F.element_at(F.split(p, "/"), -1).alias("source_file_name"), p.alias("source_file_path"), F.current_timestamp().alias("ingestion_timestamp"), F.current_date().alias("load_date"))


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Payload columns renamed and cast to text; absent ones become typed NULLs."""
    have = set(df.columns)
    return df.select(*[(F.col(a).cast("string") if a in have else F.lit(None).cast("string")).alias(b) for a, b in names.items()])


def first_column(df: DataFrame, candidates: list[str], what: str) -> str:
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"no column for {what}: {candidates}")


def require(df: DataFrame, columns: list[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")


def schema_differences(df: DataFrame, expected: dict[str, str]) -> dict[str, tuple[str | None, str]]:
    have = dict(df.dtypes)
    return {c: (have.get(c), t) for c, t in expected.items() if have.get(c) != t}


def evolve(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Adds the contract's absent columns as typed NULLs; never drops or retypes."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in contract.items() if c not in df.columns})


def chunks(start: date, end: date, days: int) -> list[tuple[date, date]]:
    """Contiguous inclusive windows of ``days`` days, 1 to 366."""
    if not 1 <= days <= 366:
        raise ValueError("a window has 1 to 366 days")
    n = max(0, (end - start).days + 1)
    return [(a := start + timedelta(i), min(end, a + timedelta(days - 1))) for i in range(0, n, days)]


def chunk_frame(spark: SparkSession, start: date, end: date, days: int) -> DataFrame:
    """The same windows as rows."""
    d = spark.sql("select 1").select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr(f"interval {int(days)} days"))).alias("desde"))
    return d.select("desde", F.least(F.date_add("desde", days - 1), F.lit(end)).alias("hasta"))


MODES = ("AUTO", "INCREMENTAL", "BACKFILL")


def resolve_window(mode: str | None, start: str | None, end: str | None, default: tuple[date, date], default_mode: str = "INCREMENTAL", today: date | None = None) -> tuple[date, date, str]:
    """Execution window (start, end, mode). AUTO stands for ``default_mode``. Only BACKFILL reads the dates: asked for by name it needs
    both, as a default it falls back on the default window without them. Dates in the wrong order or in the future raise."""
    asked, first, last = ((x or "").strip() for x in (mode, start, end))
    asked = asked.upper() or "AUTO"
    if asked not in MODES:
        raise ValueError(f"mode {mode} is none of {MODES}")
    use = default_mode if asked == "AUTO" else asked
    if use == "BACKFILL" and first and last:
        window = date.fromisoformat(first), date.fromisoformat(last)
        if not window[0] <= window[1] <= (today or date.today()):
            raise ValueError(f"window {first} to {last} is reversed or reaches into the future")
        return (*window, use)
    if asked == "BACKFILL":
        raise ValueError("a backfill needs its first and its last day")
    return (*default, use)


def covered(asked: tuple[date, date], got: tuple[date | None, date | None], max_lag: int) -> bool:
    """Whether a load covers the window: from its start, and to its end but for the allowed lag."""
    return got[0] is not None and got[1] is not None and got[0] <= asked[0] and got[1] >= asked[1] - timedelta(max_lag)


def is_transient(e: BaseException) -> bool:
    """Whether repeating may help: by the reply's status where the error carries a reply, else a broken connection or a timeout."""
    match e:
        case object(response=object(status_code=int(code))):
            return code in TRANSIENT
        case _:
            return isinstance(e, (ConnectionError, TimeoutError))


def retry(call: Callable[[], object], times: int = 5, base: float = 5, cap: float = 60, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random) -> object:
    """Repeats after transient errors with doubling waits plus jitter; other errors are raised at once."""
    for k in range(times + 1):
        try:
            return call()
        except Exception as e:
            if k == times or not is_transient(e):
                raise
            sleep(min(cap, base * 2**k) + jitter())
    raise AssertionError


class RangeReader(DataSourceReader):
    """One partition per date chunk; each executor task fetches its own windows with retries."""

    def __init__(self, options: dict, schema, fetch: Callable[[date, date], Iterator[tuple]]):
        self.fetch, self.days = fetch, int(options.get("days", 31))
        self.start, self.end = date.fromisoformat(options["start"]), date.fromisoformat(options["end"])

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(c) for c in chunks(self.start, self.end, self.days)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        """Rows as they come, none kept. After a transient error the window is fetched again and the rows already given are passed over,
        so ``fetch`` must give the same rows in the same order."""
        given = 0
        for attempt in range(6):
            try:
                for k, row in enumerate(self.fetch(*partition.value)):
                    if k >= given:
                        given = k + 1
                        yield row
                return
            except Exception as e:
                if attempt == 5 or not is_transient(e):
                    raise
                time.sleep(min(60.0, 5 * 2.0**attempt) + random.random())


def range_source(name: str, ddl: str, fetch: Callable[[date, date], Iterator[tuple]]) -> type[DataSource]:
    """A Spark data source over a date-range API: ``spark.dataSource.register(cls)``, then
    ``spark.read.format(name).option("start", ...).option("end", ...).option("days", ...).load()``."""

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ddl

        def reader(self, schema) -> DataSourceReader:
            return RangeReader(self.options, schema, fetch)

    return Source


def guard(df: DataFrame, when: str, not_before: date | None = None, today: date | None = None, max_lag: int | None = None) -> dict:
    """Publish guards in one aggregate: no rows, a maximum behind what is published, a lag above the limit."""
    r = df.agg(F.count("*").alias("n"), F.min(F.to_date(when)).alias("a"), F.max(F.to_date(when)).alias("b")).first()
    if not r["n"]:
        raise ValueError("no rows to publish")
    if not_before and r["b"] < not_before:
        raise ValueError(f"newest row {r['b']} lies behind what is published ({not_before})")
    if today and max_lag is not None and (today - r["b"]).days > max_lag:
        raise ValueError(f"newest row {r['b']} is older than {max_lag} days")
    return {"rows": r["n"], "min": r["a"], "max": r["b"]}


def publish_json(df: DataFrame, path: str, gzip: bool = True) -> int:
    """Write to a folder of its own, count what can be read back, then point ``path/_current`` to it by one rename; returns the rows.
    ``published`` tells the folder to read; a reader sees the old or the new one, never none or half of one."""
    spark = df.sparkSession
    tmp = f"{path}/run_{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "gzip" if gzip else "none").json(tmp)
    n = spark.read.schema(df.schema).json(tmp).count()
    jvm = spark.sparkContext._jvm
    p = lambda x: jvm.org.apache.hadoop.fs.Path(x)
    fs = p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    mark = p(f"{tmp}.mark")
    out = fs.create(mark, True)
    out.write(bytearray(tmp.rsplit("/", 1)[1], "utf-8"))
    out.close()
    # a numbered mark appears whole or not at all; the highest number is current
    at = len(_marks(spark, path))
    if not fs.rename(mark, p(f"{path}/_current_{at:08d}")):
        raise RuntimeError(f"{path} was published by another writer at the same time")
    return n


def _marks(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted(x.getPath().toString() for x in fs.listStatus(folder) if x.getPath().getName().startswith("_current_"))


def published(spark: SparkSession, path: str) -> str:
    """Folder of the last publication."""
    marks = _marks(spark, path)
    if not marks:
        raise FileNotFoundError(path)
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(marks[-1])
    stream = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(mark)
    name = bytes(stream.readAllBytes()).decode()
    stream.close()
    return f"{path}/{name}"


def literal(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small literal relation."""
    return spark.createDataFrame(rows, ddl)


def since_high_water(source: DataFrame, target: DataFrame | None, when: str) -> DataFrame:
    """Source rows not older than the newest target row (inclusive, so the boundary is read again); all if there is none."""
    top = target.agg(F.max(when)).first()[0] if target is not None else None
    return source if top is None else source.where(F.col(when) >= F.lit(top))


def resolve_coordinates(df: DataFrame, keys: list[str], api: DataFrame, manual: DataFrame, override: DataFrame) -> DataFrame:
    """Coordinates by precedence override, looked-up, manual fallback, missing; each lookup table is unique by the keys."""
    x = df
    for n, t in (("o", override), ("a", api), ("m", manual)):
        x = x.join(t.select(*keys, F.struct("latitud", "longitud").alias(f"_{n}")), keys, "left")
    best = F.coalesce("_o", "_a", "_m")
    src = F.when(F.col("_o").isNotNull(), "OVERRIDE").when(F.col("_a").isNotNull(), "GEOCODER").when(F.col("_m").isNotNull(), "MANUAL").otherwise("FALTANTE")
    return x.withColumn("latitud", best["latitud"]).withColumn("longitud", best["longitud"]).withColumn("fuente_coordenada", src).drop("_o", "_a", "_m")


def collected(spark: SparkSession, windows: list[tuple[date, date]], fetch: Callable[[date, date], Iterator[tuple]], ddl: str) -> DataFrame:
    """All windows fetched with retries in tasks, one window a row, united and freed of repeated rows."""
    def run(batches):
        import pandas as pd

        for b in batches:
            for a, z in zip(b["a"], b["z"], strict=True):
                rows = retry(lambda a=a, z=z: list(fetch(a, z)))
                yield pd.DataFrame(rows, columns=[c.strip().split()[0] for c in ddl.split(",")])

    w = spark.createDataFrame(windows, "a date, z date").repartition(len(windows))
    return w.mapInPandas(run, ddl).dropDuplicates()


def ingest(parts: list[DataFrame], path: str, when: str) -> dict:
    """Windows appended to gzip JSON one after the other, so no more than one is in flight; rows, first and last day run along. A window
    without rows adds nothing; none with rows raises."""
    total, first, last = 0, None, None
    for p in parts:
        r = p.agg(F.count("*").alias("n"), F.min(F.to_date(when)).alias("a"), F.max(F.to_date(when)).alias("b")).first()  # one row
        if not r["n"]:
            continue
        p.write.mode("append").option("compression", "gzip").json(path)
        total, first, last = total + r["n"], min(first or r["a"], r["a"]), max(last or r["b"], r["b"])
    if not total:
        raise ValueError("no rows to publish")
    return {"rows": total, "min": first, "max": last}
