"""Counts and numeric summaries of whole tables."""

from functools import reduce
from math import ceil, floor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.functions import numeric_columns
from emberlog.session import shared_path

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
ORDERED_ROWS = 1_000_000  # distinct values that one task puts in order
CUTS = 64  # pieces a range of values is narrowed by


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("records"))


def ingest_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Records per dataset and a TOTAL row, each table counted once."""
    counts = [row_count(df).withColumn("dataset", F.lit(name)) for name, df in tables.items()]
    return (
        reduce(DataFrame.unionByName, counts)
        .rollup("dataset")
        .agg(F.sum("records").alias("records"))
        .select(F.coalesce("dataset", F.lit("TOTAL")).alias("dataset"), "records")
    )


def distinct_entities(gold: DataFrame) -> DataFrame:
    """Users tracked (NULL is no user) and source computers seen."""
    return gold.agg(
        F.count_distinct("user").alias("users"),
        F.count_distinct("src_computer").alias("computers"),
    )


def hits_only(gold: DataFrame) -> DataFrame:
    return gold.where(F.col("malicious_hits") > 0)


def hit_rows(gold: DataFrame) -> DataFrame:
    return gold.agg(F.count_if(F.col("malicious_hits") > 0).alias("hit_rows"))


def reduction_pct(raw: DataFrame, gold: DataFrame) -> DataFrame:
    """How many percent fewer rows the summary has than the raw events (`raw`: one `records` row)."""
    both = raw.select("records", F.lit(True).alias("is_raw")).unionByName(
        row_count(gold).withColumn("is_raw", F.lit(False))
    )
    raw_rows = F.sum(F.when(F.col("is_raw"), F.col("records")))
    gold_rows = F.sum(F.when(~F.col("is_raw"), F.col("records")))
    return both.agg(
        raw_rows.alias("raw_records"),
        gold_rows.alias("gold_records"),
        (F.lit(100.0) * (F.lit(1.0) - F.try_divide(gold_rows, raw_rows))).alias("reduction_pct"),
    )


def describe_numeric(df: DataFrame, ordered_rows: int = ORDERED_ROWS) -> DataFrame:
    """count, mean, std, min, quartiles and max of each numeric column, over the whole table.

    Quartiles are exact and interpolate linearly between neighbours. Values are counted
    first (copies collapse on the map side) and stored. The range of values in which a
    rank lies is narrowed until it has at most `ordered_rows` distinct values, and only
    those are put in order, so what one task orders is bounded at any size.
    """
    df = numeric_columns(df)
    spark = df.sparkSession
    # NaN counts as missing, like NULL.
    values = {
        name: F.when(~F.isnan(F.col(f"`{name}`").cast("double")), F.col(f"`{name}`").cast("double"))
        for name in df.columns
    }
    measures = (F.count, F.avg, F.stddev_samp, F.min, F.max)
    summary = df.select(*(F.struct(*(f(v) for f in measures)).alias(name) for name, v in values.items())).first()
    basics = {name: tuple(summary[name]) for name in df.columns}
    stored = shared_path(spark, "counted")
    cells = F.array(*(F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in values.items()))
    (
        df.select(F.explode(cells).alias("cell"))
        .select("cell.*")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("rows"))
        .write.parquet(stored)
    )
    counted = spark.read.schema("column string, value double, rows long").parquet(stored)
    found = _values_at(counted, _wanted_ranks(basics), ordered_rows)
    rows = []
    for name, (count, mean, std, least, most) in basics.items():
        quartiles = []
        for share in QUARTILES.values():
            position = (count - 1) * share
            low, high = found.get((name, floor(position))), found.get((name, ceil(position)))
            quartiles.append(None if low is None else low + (high - low) * (position - floor(position)))
        rows.append((name, count, mean, std, least, *quartiles, most))
    return spark.createDataFrame(
        rows,
        "column string, count long, mean double, std double, min double,"
        " p25 double, p50 double, p75 double, max double",
    )


def _wanted_ranks(basics: dict[str, tuple]) -> list[tuple[str, int]]:
    """(column, rank) of the two neighbours of each quartile."""
    ranks = set()
    for name, (count, *_) in basics.items():
        for share in QUARTILES.values() if count else ():
            ranks |= {(name, floor((count - 1) * share)), (name, ceil((count - 1) * share))}
    return sorted(ranks)


def _values_at(counted: DataFrame, wanted: list[tuple[str, int]], ordered_rows: int) -> dict[tuple[str, int], float]:
    """The values that have the wanted ranks (from 0) in each column of (column, value, rows)."""
    spark = counted.sparkSession
    # Ranges (column, above, upto] with the number of rows before them; at most two per quartile and column.
    ranges = {want: (want[0], float("-inf"), float("inf"), 0) for want in wanted}
    kind = "column string, above double, upto double, before long"

    def inside() -> DataFrame:
        open_ranges = spark.createDataFrame(sorted(set(ranges.values())), kind)
        fits = (F.col("value") > F.col("above")) & (F.col("value") <= F.col("upto"))
        # An infinite value lies in the first range, which is open below.
        fits = fits | ((F.col("value") == float("-inf")) & (F.col("above") == float("-inf")))
        return counted.join(F.broadcast(open_ranges), "column").where(fits)

    while ranges:
        by_range = inside().groupBy("column", "above", "upto", "before")
        sizes = by_range.agg(
            F.count("*").alias("distinct"),
            F.percentile_approx("value", [i / CUTS for i in range(1, CUTS)], 1000).alias("cuts"),
        ).collect()
        wide = {tuple(r)[:4]: sorted(set(r["cuts"])) for r in sizes if r["distinct"] > ordered_rows}
        if not wide:
            break
        cuts = F.broadcast(spark.createDataFrame([(*k, v) for k, v in wide.items()], kind + ", cuts array<double>"))
        piece = F.size(F.filter("cuts", lambda cut: cut < F.col("value")))
        parts = (
            inside()
            .join(cuts, ["column", "above", "upto", "before"])
            .groupBy("column", "above", "upto", "before", piece.alias("piece"))
            .agg(F.sum("rows").alias("rows"))
            .collect()
        )
        held = {(tuple(r)[:4], r["piece"]): r["rows"] for r in parts}
        for want, old in ranges.items():
            if old not in wide:
                continue
            before, edges = old[3], [old[1], *wide[old], old[2]]
            for i in range(len(edges) - 1):
                rows = held.get((old, i), 0)
                if want[1] < before + rows:
                    ranges[want] = (old[0], edges[i], edges[i + 1], before)
                    break
                before += rows
    if not ranges:
        return {}
    running = F.sum("rows").over(Window.partitionBy("column", "above", "upto").orderBy("value")) + F.col("before")
    ranked = inside().withColumn("end", running)
    asked = F.broadcast(spark.createDataFrame([(c, r, *ranges[c, r][1:3]) for c, r in wanted], "column string, rank long, above double, upto double"))
    hits = ranked.join(asked, ["column", "above", "upto"]).where(
        (F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("rows"))
    )
    return {(r["column"], r["rank"]): r["value"] for r in hits.select("column", "rank", "value").collect()}
