"""The profile of a growing table: facts and value counts of each file are kept, and only new files are read.

Of every file the state holds one row of mergeable facts per column and the histogram of its cells. A run lists
the files, reads those it has no state of, adds their states in one commit, and merges the states of
all files that are there: counts add up, extremes are compared, means and variances are combined, and
histograms are summed by value. Nothing of the result is an estimate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline import constants as K
from plumbline.functions.columns import DATE, NUMERIC, kinds, literal, normalise, quoted
from plumbline.functions.parsing import to_number, to_timestamp
from plumbline.operators import distinct, infer
from plumbline.operators.facts import FACTS, _scans
from plumbline.session import pin, union_all
from plumbline.sources import history

FILES = "file string, modified timestamp, bytes bigint"
STATE = (
    "file string, position int, column string, kind string, row_count bigint, null_count bigint, "
    "num_n bigint, num_min double, num_max double, num_mean double, num_var double, negative_count bigint, "
    "date_min timestamp_ntz, date_max timestamp_ntz"
)
VALUES = "file string, position int, slot string, value string, bits int, n bigint"
FILE = "__file__"
ROW = "__row__"
NUMBER = "__number__"
#: Cells, or values of the state, that one task groups at most on average: a file or a part of it may hold any number.
CELLS = 250_000


@dataclass
class FileProfile:
    """`columns` as `infer_columns` gives them; `values` the merged histogram (table, column, value, n, of typed
    values as text, long text as its digest); `read` the files this run has read."""

    columns: DataFrame
    values: DataFrame
    read: list[str]

    def top_values(self, k: int = K.TOP_VALUES) -> DataFrame:
        """The most frequent values of key and category columns, as the full profile lists them."""
        wanted = self.columns.where("inferred_type IN ('id', 'categorical')").select("table", "column")
        counts = self.values.join(F.broadcast(wanted), ["table", "column"])  # one row per column
        return distinct.top_values(counts.select("table", "column", "value", "n"), k)

    def smallest_values(self, k: int = K.SAMPLE_VALUES) -> DataFrame:
        """The least distinct values of every column but long text, in the order of its type."""
        parts = []
        for slot in distinct.SLOTS:
            order = Window.partitionBy("table", "column").orderBy(F.col("value").cast(slot))
            rows = self.values.where((F.col("slot") == slot) & ~F.col("digest"))
            parts.append(rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
        return union_all(parts).select("table", "column", "rank", "value")


def _listing(spark: SparkSession, source: str) -> DataFrame:
    """The Parquet files below a folder with time and size; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    meta = F.col("_metadata")
    return found.load(source).select(
        meta["file_path"].alias("file"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
        "path",
    )


def _facts(df: DataFrame) -> DataFrame:
    """Mergeable facts of every column by file."""
    plan = []
    for position, (name, kind) in enumerate((n, k) for n, k in kinds(df).items() if n != FILE):
        column = quoted(name)
        exprs = {"null_count": f"count_if({column} IS NULL)"}
        if kind == NUMERIC:
            number = f"CAST({column} AS DOUBLE)"
            exprs |= {
                "num_n": f"count({number})", "num_min": f"min({number})", "num_max": f"max({number})",
                "num_mean": f"avg({number})", "num_var": f"var_pop({number})",
                "negative_count": f"count_if({number} < 0)",
            }
        if kind == DATE:
            moment = f"CAST({column} AS TIMESTAMP_NTZ)"
            exprs |= {"date_min": f"min({moment})", "date_max": f"max({moment})"}
        plan.append((position, name, exprs))
    column_kinds = kinds(df)
    types = dict(part.split(" ", 1) for part in STATE.split(", ")[5:])
    parts = []
    for group in _scans(plan):
        wanted = [F.expr(e).alias(f"{p}_{fact}") for p, _, exprs in group for fact, e in exprs.items()]
        scan = df.groupBy(FILE).agg(F.count("*").alias("row_count"), *wanted)
        rows = [
            f"struct({position} AS position, {literal(name)} AS column, {literal(column_kinds[name])} AS kind, row_count, "
            + ", ".join(
                f"CAST({f'`{position}_{fact}`' if fact in exprs else 'NULL'} AS {kind}) AS {fact}"
                for fact, kind in types.items()
            )
            + ")"
            for position, name, exprs in group
        ]
        parts.append(scan.selectExpr(f"`{FILE}` AS file", f"inline(array({', '.join(rows)}))"))
    return union_all(parts)


def _tasks(cells: int) -> int:
    return max(1, -(-cells // CELLS))


def _with_origin(found: DataFrame) -> DataFrame:
    """The rows of Parquet files with their file and their place in it."""
    return normalise(found).withColumns({FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")})


def _values(df: DataFrame, files: list[str]) -> DataFrame:
    """The histogram of every column by file. Text is tested while it is at hand; long text that is neither
    number nor date is kept as its digest.

    Before the values are grouped, rows are dealt out evenly, so that no task has to hold the values of
    a whole file; and files are numbered, so that their names are not held with each value."""
    fields = [f for f in df.schema.fields if f.name not in (FILE, ROW)]
    spark = df.sparkSession
    numbers = F.broadcast(spark.createDataFrame(list(enumerate(files)), f"{NUMBER} int, {FILE} string"))  # names of files
    rows = df.count()
    parts = []
    for slot in distinct.SLOTS:
        pairs = [
            f"{position}, CAST({quoted(f.name)} AS {slot})"
            for position, f in enumerate(fields)
            if distinct._slot(f.dataType) == slot
        ]
        if not pairs:
            continue
        chosen = df.select(FILE, ROW, *[quoted(f.name) for f in fields if distinct._slot(f.dataType) == slot])
        numbered = chosen.join(numbers, FILE).drop(FILE)
        dealt = numbered.repartition(_tasks(rows * len(pairs)), NUMBER, ROW)
        cells = dealt.selectExpr(NUMBER, f"stack({len(pairs)}, {', '.join(pairs)}) AS (position, value)")
        counted = cells.where("value IS NOT NULL").groupBy(NUMBER, "position", "value").agg(F.count("*").alias("n"))
        counted = counted.join(numbers, NUMBER).withColumnRenamed(FILE, "file")
        text = F.col("value").cast("string")
        bits = F.lit(0) if slot != "string" else distinct._test_bits(F.col("value"))
        counted = counted.select("file", "position", F.lit(slot).alias("slot"), text.alias("value"), bits.alias("bits"), "n")
        if slot == "string":
            parsed = F.lit(0)
            for i, name in enumerate(distinct.TEXT_TESTS):
                if name in ("date_value_count", "number_count"):
                    parsed = parsed.bitwiseOR(F.lit(1 << i))
            plain = F.col("bits").bitwiseAND(parsed) != 0
            counted = counted.withColumn("value", F.when(plain, F.col("value")).otherwise(distinct.compact(F.col("value"))))
        parts.append(counted)
    return union_all(parts) if parts else spark.createDataFrame([], VALUES)


def _merged_facts(states: DataFrame, table: str) -> DataFrame:
    """One row per column: the facts of all files together."""
    n = F.sum("num_n")
    mean = F.sum(F.col("num_n") * F.col("num_mean")) / n
    keys = ["position", "column", "kind"]
    whole = states.groupBy(*keys).agg(
        *(F.sum(name).alias(name) for name in ("row_count", "null_count", "negative_count")),
        *(F.min(name).alias(name) for name in ("num_min", "date_min")),
        *(F.max(name).alias(name) for name in ("num_max", "date_max")),
        n.alias("num_n"),
        mean.alias("num_mean"),
    )
    centre = whole.select("position", F.col("num_mean").alias("centre"))
    apart = F.col("num_var") + F.pow(F.col("num_mean") - F.col("centre"), 2)
    spread = (
        states.join(F.broadcast(centre), "position")  # one row per column
        .groupBy("position")
        .agg(F.sum(F.col("num_n") * apart).alias("spread"))
    )
    std = F.when(F.col("num_n") > 1, F.sqrt(F.col("spread") / (F.col("num_n") - 1)))
    return (
        whole.join(F.broadcast(spread), "position", "left")
        .withColumns({"table": F.lit(table), "num_std": std})
        .drop("spread", "num_n")
    )


def _merged_values(values: DataFrame, table: str, names: list[str]) -> DataFrame:
    """The histogram of all files together."""
    listing = F.array(*[F.lit(name) for name in names or [""]])
    # a value comes once a file, so nothing is gained by grouping before the shuffle
    dealt = values.repartition(_tasks(values.count()), "position", "slot", "value")
    summed = dealt.groupBy("position", "slot", "value").agg(F.max("bits").alias("bits"), F.sum("n").alias("n"))
    is_digest = (F.col("slot") == "string") & (F.length("value") >= distinct.LONG_TEXT) & (F.col("bits") < 2)
    return summed.select(
        F.lit(table).alias("table"), listing[F.col("position")].alias("column"),
        "position", "slot", "value", "bits", "n", is_digest.alias("digest"),
    )


def _counted(values: DataFrame) -> DataFrame:
    rows = [
        F.sum(F.when(F.col("bits").bitwiseAND(F.lit(1 << i)) != 0, F.col("n")).otherwise(0)).alias(name)
        for i, name in enumerate(distinct.TEXT_TESTS)
    ]
    is_text = F.bool_or(F.col("slot") == "string")  # a column has one slot; text as state would take sorting
    tests = [F.when(is_text, total).alias(name) for total, name in zip(rows, distinct.TEXT_TESTS)]
    repeated = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeated_rows")
    return values.groupBy("table", "column").agg(F.count("*").alias("unique_count"), repeated, *tests)


def _parsed(values: DataFrame, columns: DataFrame, as_of: str | None) -> DataFrame:
    """Statistics of text that is numbers or dates, and future dates, from the histogram."""
    wanted = columns.where("kind = 'string' AND inferred_type IN ('numeric', 'date') OR kind = 'date'")
    rows = values.join(F.broadcast(wanted.select("table", "column", "kind", "inferred_type")), ["table", "column"])
    number = F.when(F.col("inferred_type") == "numeric", to_number(F.col("value")))
    moment = F.when(F.col("kind") == "date", F.col("value").cast("timestamp_ntz")).when(
        F.col("inferred_type") == "date", to_timestamp(F.col("value"))
    )
    rows = rows.select("table", "column", "n", number.alias("x"), moment.alias("day"))
    many = F.sum(F.when(F.col("x").isNotNull(), F.col("n")))
    mean = F.sum(F.col("x") * F.col("n")) / many
    future = F.col("day") > F.lit(as_of).cast("timestamp_ntz")
    whole = rows.groupBy("table", "column").agg(
        F.min("x").alias("p_min"), F.max("x").alias("p_max"), mean.alias("p_mean"), many.alias("p_n"),
        F.sum(F.when(F.col("x").isNotNull(), F.when(F.col("x") < 0, F.col("n")).otherwise(0))).alias("p_negative"),
        F.min("day").alias("p_first"), F.max("day").alias("p_last"),
        F.sum(F.when(F.col("day").isNotNull(), F.when(future, F.col("n")).otherwise(0))).alias("p_future"),
    )
    whole = pin(whole)  # one row per column
    spread = (
        rows.where("x IS NOT NULL")
        .join(F.broadcast(whole.select("table", "column", "p_mean")), ["table", "column"])
        .groupBy("table", "column")
        .agg(F.sum(F.col("n") * F.pow(F.col("x") - F.col("p_mean"), 2)).alias("p_spread"))
    )
    return whole.join(F.broadcast(spread), ["table", "column"], "left")


def profile_files(
    spark: SparkSession,
    source: str,
    state: str,
    table: str = "table",
    as_of: str | None = None,
    schema: StructType | None = None,
) -> FileProfile:
    """Profile the Parquet files below `source`, reading only those that `state` doesn't know.

    A file is known by path, time and size: one that was written anew is read anew, and one that is gone no
    longer counts. All files must have the columns of the first run (or `schema`). A run that is broken off
    before its commit leaves nothing that counts. The columns are those `infer_columns` gives for the
    whole table; text columns of numbers or dates have their statistics too. Files are listed by the driver,
    as Spark lists what it reads; values never are."""
    files = _listing(spark, source)
    ready = [row["written_as"] for row in history.commits(spark, state).select("written_as").collect()]
    known = history.part(spark, state, "files", FILES, ready)
    identity = ["file", "modified", "bytes"]
    unknown = files.join(known, identity, "left_anti").select("path", "file").collect()
    new = [row["path"] for row in unknown]
    if new:
        reader = spark.read.option("basePath", source)
        found = (reader.schema(schema) if schema else reader).parquet(*sorted(new))
        rows = _with_origin(found)
        fresh = files.join(spark.createDataFrame([(p,) for p in new], "path string"), "path").select(*identity)
        histogram = _values(rows, [row["file"] for row in unknown])
        history.add(spark, state, {"facts": _facts(rows.drop(ROW)), "values": histogram, "files": fresh})
        ready = [row["written_as"] for row in history.commits(spark, state).select("written_as").collect()]
    # a file's state counts if it was written for the file as it is now
    present = pin(_present(spark, state, files, ready))
    states = _of_present(spark, state, "facts", STATE, present)
    facts = pin(_merged_facts(states, table))
    names = [row["column"] for row in facts.select("position", "column").orderBy("position").collect()]
    values = _merged_values(_of_present(spark, state, "values", VALUES, present), table, names)
    return _assembled(facts, values, as_of, sorted(new))


def _present(spark: SparkSession, state: str, files: DataFrame, ready: list[str]) -> DataFrame:
    """The files that are there, each with the commit that holds its state."""
    parts = [history.part(spark, state, "files", FILES, [one]).withColumn("written_as", F.lit(one)) for one in ready]
    listed = union_all(parts) if parts else spark.createDataFrame([], FILES + ", written_as string")
    return files.select("file", "modified", "bytes").join(listed, ["file", "modified", "bytes"]).select("file", "written_as")


def _of_present(spark: SparkSession, state: str, name: str, schema: str, present: DataFrame) -> DataFrame:
    """The state rows of the files that are there; commits none of whose files are left are not read."""
    used = [row["written_as"] for row in present.select("written_as").distinct().collect()]
    parts = [
        history.part(spark, state, name, schema, [one]).join(
            F.broadcast(present.where(F.col("written_as") == one).select("file")), "file"  # names of files
        )
        for one in sorted(used)
    ]
    return union_all(parts) if parts else spark.createDataFrame([], schema)


def _assembled(facts: DataFrame, values: DataFrame, as_of: str | None, read: list[str]) -> FileProfile:
    counts = pin(_counted(values))
    typed = infer.with_foreign_key_hint(
        infer.with_percentages(infer.with_types(facts.join(F.broadcast(counts), ["table", "column"], "left")))
    )
    columns = pin(infer.with_primary_key(pin(typed)))
    parsed = pin(_parsed(values, columns, as_of))
    text = F.col("kind") == "string"
    std = F.when(F.col("p_n") > 1, F.sqrt(F.col("p_spread") / (F.col("p_n") - 1)))
    named = {"num_min": "p_min", "num_max": "p_max", "num_mean": "p_mean", "negative_count": "p_negative",
             "date_min": "p_first", "date_max": "p_last"}
    merged = columns.join(F.broadcast(parsed), ["table", "column"], "left").withColumns(
        {name: F.when(text, F.col(other)).otherwise(F.col(name)) for name, other in named.items()}
        | {"num_std": F.when(text, std).otherwise(F.col("num_std"))}
        | {"date_future": F.when(F.lit(as_of is not None), F.col("p_future"))}
    )
    kept = ["table", "column", "position", "kind", "row_count", *(name for name, _, _ in FACTS)]
    rest = [c for c in columns.columns if c not in kept]
    return FileProfile(pin(merged.select(*kept, *rest)), values, read)
