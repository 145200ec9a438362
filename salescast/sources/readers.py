"""Scans, schema operators and sinks.

Landed exports are read with explicit schemas (no inference pass) in the dialect that
their own lines support; rejected lines are split off, counted and kept with a reason,
and only too many of them stop a job; sources are unioned by name with missing columns
as null and conformed to the canonical schema.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class SourceSpec:
    """One configured export source: where it lies, how it is written, how its
    columns are called, and whether it is the primary one (its failure is an error)."""
    name: str
    path: str
    sep: str = ","
    encoding: str = "UTF-8"
    renames: Mapping[str, str] = field(default_factory=dict)
    primary: bool = False
    schema: T.StructType | None = None
    header: bool = True


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",",
             encoding: str = "UTF-8", escape: str = '"', header: bool = True) -> DataFrame:
    """S01 + S02 + S04 + S05: typed CSV scan; malformed rows land in ``_corrupt``
    (short rows padded with null, long rows truncated); without a schema every
    column is read as string.

    With ``header`` Spark skips the first line of *every* file of the folder,
    so only read multi-file folders that way when each file starts with the
    header (as Spark's own CSV writer does)."""
    r = (spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
         .option("escape", escape).option("mode", "PERMISSIVE"))
    if schema is not None:
        # With column pruning in the CSV parser only the referenced columns are
        # tokenised, and short/long rows are no longer flagged in ``_corrupt``: this
        # read does without it.
        r = r.option("columnPruning", False)
        schema = T.StructType(list(schema.fields) + [T.StructField("_corrupt", T.StringType(), True)])
        r = r.schema(schema).option("columnNameOfCorruptRecord", "_corrupt")
    return r.csv(path)


def pad_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Short rows padded with '' instead of null for the given string columns."""
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in cols else F.col(c) for c in df.columns])


# Dialects that are tried when the declared one does not fit.
SEPARATORS = (",", ";", "\t", "|")
ESCAPES = ('"', "\\")
# Lines of a source that are looked at to choose its dialect, and the share of them that may be rejected.
EVIDENCE_LINES = 20_000
REJECTED_SHARE = 0.2


@dataclass(frozen=True)
class Dialect:
    """How a source is read: ``step`` is typed, other (separator or escape), strings or empty."""
    step: str
    sep: str = ","
    escape: str = '"'
    schema: T.StructType | None = None
    rejected_share: float = 0.0


def _flagged(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType(), True)])


def choose_dialect(spark: SparkSession, spec: SourceSpec, lines: int = EVIDENCE_LINES, share: float = REJECTED_SHARE) -> Dialect:
    """S02 + S05: the first step of the chain that the source's own lines support.

    The candidates parse the same lines (the first ``lines`` of the source, header lines left
    out), the declared one first, all others in one aggregate if it does not fit.  The declared dialect is taken if it rejects no more
    than ``share`` of them; else the other separator and escape that rejects least, if that is
    within ``share``; else all columns as strings, by the dialect that gives the right number of
    columns most often.  A source that is not there is empty, unless it is the primary one;
    without a schema there is nothing to reject, and strings are read as declared."""
    try:
        raw = spark.read.option("encoding", spec.encoding).csv(spec.path, schema="value string", sep="\u0001", quote="\u0000")
        raw = raw.where(F.length(F.trim("value")) > 0).limit(lines)
        raw.schema  # noqa: B018  a missing path fails here
    except AnalysisException as e:
        if spec.primary:
            raise ValueError(f"primary source {spec.name} cannot be read: {e}") from e
        return Dialect("empty", spec.sep, schema=spec.schema)
    if spec.schema is None:
        return Dialect("strings", spec.sep)
    strings = T.StructType([T.StructField(f.name, T.StringType()) for f in spec.schema.fields])
    tried = list(dict.fromkeys([(spec.sep, '"'), *[(s, e) for s in SEPARATORS for e in ESCAPES]]))

    def rejected(schema: T.StructType, sep: str, escape: str) -> tuple[Column, Column]:
        options = {"sep": sep, "escape": escape, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _flagged(schema).fields)
        row = F.from_csv("value", fields, options)
        heading = F.lit(False)
        if spec.header:
            first = F.trim(F.regexp_replace(F.split_part("value", F.lit(sep), F.lit(1)), '"', ""))
            heading = first == spec.schema.fields[0].name
        return F.count_if(row["_corrupt"].isNotNull() & ~heading), F.count_if(~heading)

    def shares(kinds: Sequence[tuple[T.StructType, tuple[str, str]]]) -> list[float]:
        seen = raw.agg(*[x.alias(f"{what}{i}") for i, (schema, how) in enumerate(kinds)
                         for what, x in zip(("bad", "all"), rejected(schema, *how))]).first()
        return [seen[f"bad{i}"] / seen[f"all{i}"] if seen[f"all{i}"] else 0.0 for i in range(len(kinds))]

    declared = shares([(spec.schema, tried[0])])[0]
    if declared <= share:
        return Dialect("typed", *tried[0], spec.schema, declared)
    found = shares([(schema, how) for schema in (spec.schema, strings) for how in tried])
    typed, plain = found[:len(tried)], found[len(tried):]
    best = typed.index(min(typed))
    if typed[best] <= share:
        return Dialect("other", *tried[best], spec.schema, typed[best])
    best = plain.index(min(plain))
    return Dialect("strings", *tried[best], strings, plain[best])


def read_source(spark: SparkSession, spec: SourceSpec, dialect: Dialect | None = None) -> DataFrame:
    """S02 + S05: one configured source in the dialect its lines support (see :func:`choose_dialect`)."""
    d = dialect or choose_dialect(spark, spec)
    if d.step == "empty":
        return spark.createDataFrame([], d.schema or T.StructType([]))
    return read_csv(spark, spec.path, d.schema, d.sep, spec.encoding, d.escape, spec.header)


@dataclass(frozen=True)
class Ingested:
    """What the scans took and what they rejected."""
    good: DataFrame
    rejected: DataFrame              # data_source, line, reason
    counts: dict[str, tuple[int, int]]  # per source: lines, rejected lines
    dialects: dict[str, Dialect]


class TooManyRejected(ValueError):
    """More lines of a source were rejected than the limit allows."""


def rejection_reason(line: Column, dialect: Dialect) -> Column:
    """Why a typed scan flagged a line: another number of columns, or a value of another type."""
    sep = re.escape(dialect.sep)
    outside_quotes = f'{sep}(?=(?:[^"]*"[^"]*")*[^"]*$)'
    n = F.size(F.split(line, outside_quotes, -1))
    return F.when(n != len(dialect.schema.fields), F.lit("columns")).otherwise(F.lit("value"))


def ingest_sources(spark: SparkSession, specs: Sequence[SourceSpec], limit: float = 0.5) -> Ingested:
    """S01 + S03: all configured sources, with rejected lines split off.

    Each source is parsed once, into a parquet copy under the shared folder that has the good
    rows and the rejected lines in folders of their own; an ``Observation`` of that same job
    counts both.  If more than ``limit`` of a source's lines are rejected the job stops with
    :class:`TooManyRejected`; the copy with the lines stays for a look."""
    good, bad, counts, dialects = [], [], {}, {}
    none = spark.createDataFrame([], "data_source string, line string, reason string")
    for spec in specs:
        d = dialects[spec.name] = choose_dialect(spark, spec)
        df = read_source(spark, spec, d)
        if d.step == "empty" or d.schema is None:
            good.append(standardize(df, spec.renames, spec.name))
            continue
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest/{spec.name}-{uuid.uuid4().hex}"
        rejected = F.col("_corrupt").isNotNull()
        seen = Observation(f"{spec.name}-{uuid.uuid4().hex}")
        df = df.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(rejected).alias("rejected"))
        df.withColumn("_rejected", rejected.cast("int")).write.partitionBy("_rejected").parquet(path)
        counts[spec.name] = (seen.get["lines"], seen.get["rejected"])
        if counts[spec.name][1] > limit * counts[spec.name][0]:
            raise TooManyRejected(f"{spec.name}: {counts[spec.name][1]} of {counts[spec.name][0]} lines rejected, see {path}")
        stored = spark.read.schema(T.StructType([*_flagged(d.schema).fields, T.StructField("_rejected", T.IntegerType())])).parquet(path)
        good.append(standardize(stored.where("_rejected = 0").drop("_corrupt", "_rejected"), spec.renames, spec.name))
        bad.append(stored.where("_rejected = 1").select(
            F.lit(spec.name).alias("data_source"), F.col("_corrupt").alias("line"),
            rejection_reason(F.col("_corrupt"), d).alias("reason")))
    return Ingested(union_sources(good), reduce(DataFrame.unionByName, bad, none), counts, dialects)


def read_sources(spark: SparkSession, specs: Sequence[SourceSpec], limit: float = 0.5) -> DataFrame:
    """The good rows of all configured sources, standardised, tagged and unioned by name."""
    return ingest_sources(spark, specs, limit).good


def unique_names(names: Sequence[str]) -> list[str]:
    """Every copy of a repeated column name gets a running suffix (x, x become x_0,
    x_1); a suffix that would meet another column's name is passed over."""
    repeated = {n for n in names if list(names).count(n) > 1}
    taken = set(names) - repeated
    out, following = [], dict.fromkeys(repeated, 0)
    for n in names:
        if n in repeated:
            while f"{n}_{following[n]}" in taken:
                following[n] += 1
            n = f"{n}_{following[n]}"
            taken.add(n)
        out.append(n)
    return out


def standardize(df: DataFrame, renames: Mapping[str, str], source: str) -> DataFrame:
    """P01 + P03: per-source rename map, unique names, source tag."""
    df = df.toDF(*unique_names(df.columns))
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present).withColumn("data_source", F.lit(source))


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """U01 + P04: union by name, columns missing in a source become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add missing columns as typed nulls, order as the schema, drop extras."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
                       .alias(f.name) for f in schema.fields])


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Plan-time required-column check (no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                sep: str = ",") -> None:
    """Sink (overwrite), optionally partitioned (e.g. by event month for pruning)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("sep", sep).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


# Forecast payload (FIXTURES F4)
FORECAST_SCHEMA = T.StructType([
    T.StructField("dt_txt", T.StringType()),
    T.StructField("main", T.StructType([T.StructField("temp_max", T.DoubleType()),
                                        T.StructField("temp_min", T.DoubleType())])),
    T.StructField("rain", T.StructType([T.StructField("3h", T.DoubleType())])),
    T.StructField("wind", T.StructType([T.StructField("gust", T.DoubleType()),
                                        T.StructField("speed", T.DoubleType())])),
])


def flatten_forecast(df: DataFrame, json_col: str = "payload") -> DataFrame:
    """JSON forecast -> flat rows, one per entry.  A payload is one entry, or an
    envelope ``{"list": [entry, ...]}``.  Rain defaults to 0, wind is the gust else the
    speed (0 without), m/s -> km/h (x3.6).  Entries without a readable time or
    temperatures are skipped."""
    text = F.col(json_col)
    envelope = F.from_json(text, T.StructType([T.StructField("list", T.ArrayType(FORECAST_SCHEMA))]))["list"]
    entries = F.coalesce(envelope, F.array(F.from_json(text, FORECAST_SCHEMA)))
    p = df.select(F.explode(entries).alias("p")).select("p", F.col("p.dt_txt").try_cast("timestamp").alias("obs_ts"))
    p = p.where(F.col("obs_ts").isNotNull() & F.col("p.main.temp_max").isNotNull() & F.col("p.main.temp_min").isNotNull())
    return p.select("obs_ts", F.col("p.main.temp_max").alias("temp_max"), F.col("p.main.temp_min").alias("temp_min"),
                    F.coalesce(F.col("p.rain").getField("3h"), F.lit(0.0)).alias("rain_mm"),
                    (F.coalesce(F.col("p.wind.gust"), F.col("p.wind.speed"), F.lit(0.0)) * 3.6).alias("wind_kmh"))


# Artist payload (FIXTURES F6, API form)
ARTIST_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("followers", T.StructType([T.StructField("total", T.DoubleType())])),
    T.StructField("genres", T.ArrayType(T.StringType())),
])


def flatten_artist(df: DataFrame, json_col: str = "payload") -> DataFrame:
    """Artist JSON -> metrics rows with the genres joined by ', '.  A payload is one
    artist or a search answer ``{"artists": {"items": [artist, ...]}}``; entries without
    a name are skipped."""
    text = F.col(json_col)
    answer = T.StructType([T.StructField("artists", T.StructType([T.StructField("items", T.ArrayType(ARTIST_SCHEMA))]))])
    found = F.coalesce(F.from_json(text, answer)["artists"]["items"], F.array(F.from_json(text, ARTIST_SCHEMA)))
    p = df.select(F.explode(found).alias("p")).where(F.col("p.name").isNotNull())
    return p.select(F.col("p.name").alias("artist"), F.col("p.popularity").alias("SpotifyPopularity"),
                    F.col("p.followers.total").alias("SpotifyFollowers"),
                    F.array_join(F.col("p.genres"), ", ").alias("genres"))


def load_tables(spark: SparkSession, tickets: str, line_up: str | None = None, artists: str | None = None,
                fmt: str = "csv", schemas: Mapping[str, T.StructType] | None = None) -> tuple:
    """The three-table loader.  The ticket table is required; an optional table that is
    not given or not there becomes empty, with its schema."""
    schemas = schemas or {}

    def scan(path: str, name: str) -> DataFrame:
        r = spark.read.format(fmt)
        if fmt == "csv":
            r = r.option("header", True)
        return (r.schema(schemas[name]) if name in schemas else r).load(path)

    def optional(path: str | None, name: str) -> DataFrame:
        try:
            if path is not None:
                return scan(path, name)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        return spark.createDataFrame([], schemas.get(name, T.StructType([])))

    return scan(tickets, "tickets"), optional(line_up, "line_up"), optional(artists, "artists")


def normalise_table(df: DataFrame, keys: Sequence[str] = (), dates: Sequence[str] = ()) -> DataFrame:
    """Key columns folded (X01), date columns read as UTC
    timestamps; columns that are not there are passed over."""
    from salescast.functions.text import with_normalized

    for c in dates:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("string").try_cast("timestamp"))
    for c in keys:
        if c in df.columns:
            df = with_normalized(df, c)
    return df


def load_normalised(spark: SparkSession, tickets: str, line_up: str | None = None, artists: str | None = None,
                    fmt: str = "csv", schemas: Mapping[str, T.StructType] | None = None) -> tuple:
    """:func:`load_tables` with keys and dates of all three tables normalised."""
    t, lu, a = load_tables(spark, tickets, line_up, artists, fmt, schemas)
    dates = ("event_date", "first_event_date_start", "last_event_date_end", "verkoopdatum")
    return (normalise_table(t, ("event_name",), dates), normalise_table(lu, ("event_name", "artist"), ("event_date",)),
            normalise_table(a, ("artist",), ("Date",)))
