"""Quality profile of raw files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamgrid.functions import documents as D
from roamgrid.functions.cells import degree_cell
from roamgrid.functions.times import offset_minutes, sane_date_text
from roamgrid.operators.cleaning import parse_lines
from roamgrid.schemas import RAW_DATE, RAW_ID, RAW_LOCAL_TIME, RAW_SOURCE, RAW_SPECIES
from roamgrid.session import materialize
from roamgrid.sources.raw import POSITION, parsed_prefix

# Fixed value: label of an offset that cannot be computed.
NO_OFFSET = "sin_dato"
EVENT = ["species", "lng", "lat", "date"]


def _by_value(line: Column, text: Column) -> Column:
    """A species id as text that is equal for equal JSON values: 134 and 134.0, 1 and true; a quoted number is another value.

    Lines with NaN are no strict JSON, so ``text`` is NULL there and the value is cut out of the line.
    """
    name = f'"{RAW_SPECIES}"\\s*:\\s*'
    cut = F.regexp_extract(line, name + r'"?([^",}\s]+)', 1)
    value = F.coalesce(text, F.when(~cut.isin("", "null"), cut))
    number = F.when(value == "true", 1.0).when(value == "false", 0.0).otherwise(value.try_cast("double"))
    return F.when(line.rlike(name + '"') | number.isNull(), F.concat(F.lit('"'), value)).otherwise(number.cast("string"))


def profile_rows(raw: DataFrame) -> DataFrame:
    """One row per line with everything the profile counts; rows that are no document have only their status."""
    parsed = parse_lines(raw)
    line, doc = F.col("value"), F.col("doc")
    lng, lat = D.lng_lat(doc)
    typed_species, text_species = doc[RAW_SPECIES], F.get_json_object(line, f"$.{RAW_SPECIES}")
    date_text = doc[RAW_DATE]["$date"]
    category = D.coord_category(line, doc)
    located = F.col("category").isin(D.COORD_CATEGORIES[5:])
    columns = {
        "oid": doc[RAW_ID]["$oid"],
        "keys": D.key_signature(line),
        "source": F.coalesce(doc[RAW_SOURCE], F.lit("None")),
        "species_id": typed_species,
        "species": _by_value(line, text_species),
        "category": category,
        "lng": lng,
        "lat": lat,
        "has_date": date_text.isNotNull(),
        "date": sane_date_text(date_text),
        "offset": offset_minutes(doc[RAW_LOCAL_TIME], date_text),
    }
    is_doc = F.col("status") == "doc"
    rows = parsed.select(*POSITION, "status", F.when(F.col("status") == "invalid", line).alias("value"),
                         *[F.when(is_doc, c).alias(n) for n, c in columns.items()])
    return rows.withColumns({"lng": F.when(located, F.col("lng")), "lat": F.when(located, F.col("lat"))})


def _counters() -> list[Column]:
    status, ok = F.col("status"), F.col("category") == "ok"
    is_doc = status == "doc"
    return [
        F.count_if(is_doc).alias("rows"), F.count_if(status == "blank").alias("blank"),
        F.count_if(status == "invalid").alias("invalid_json"),
        F.count_if(is_doc & ~D.valid_species(F.col("species_id"))).alias("id_invalid"),
        F.count_if(is_doc & ~F.col("has_date")).alias("no_date"),
        F.count_if(is_doc & F.col("has_date") & F.col("date").isNull()).alias("bad_date"),
        F.min("date").alias("date_min"), F.max("date").alias("date_max"),
        F.min(F.when(ok, F.col("lat"))).alias("lat_min"), F.max(F.when(ok, F.col("lat"))).alias("lat_max"),
        F.min(F.when(ok, F.col("lng"))).alias("lng_min"), F.max(F.when(ok, F.col("lng"))).alias("lng_max"),
    ]



def profile_files(rows: DataFrame) -> DataFrame:
    """Counters and extremes per file."""
    return rows.groupBy("file").agg(*_counters())


def _summed(per_file: DataFrame, names: dict[str, str]) -> DataFrame:
    """One row with the sums over files, renamed."""
    return per_file.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in names.items()])


def profile_totals(rows: DataFrame, sample: DataFrame | None = None) -> DataFrame:
    """The total row of the profile: counters and extremes over all files, repeated ids and events, and, with the table of
    ``profile_sample``, its totals in columns ``sample_*``. The single rows of the parts are stacked and folded into one."""
    parts = [rows.agg(*_counters()), _summed(profile_dups(rows), {c: c for c in ("dup_id", "dup_event")})]
    if sample is not None:
        parts.append(_summed(sample, {c: f"sample_{c}" for c in ("rows", "coords_ok", "dup_event", "usable")}))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def profile_freq(rows: DataFrame) -> DataFrame:
    """``file, dim, value, count`` for all frequency tables in one pass and one combining shuffle."""
    dated = F.col("date").isNotNull()
    valid = D.valid_species(F.col("species_id"))
    values: dict[str, Column] = {
        "source": F.col("source"),
        "keys": F.col("keys"),
        "coords": F.col("category"),
        "species": F.when(valid, F.col("species_id").cast("string")),
        "day": F.substring("date", 1, 10),
        "offset": F.when(dated, F.coalesce(F.col("offset").cast("string"), F.lit(NO_OFFSET))),
        "cell": F.when(F.col("category") == "ok", degree_cell(F.col("lng"), F.col("lat"))),
    }
    entries = F.array(*[F.struct(F.lit(d).alias("dim"), v.alias("value")) for d, v in values.items()])
    long = rows.filter(F.col("status") == "doc").select("file", F.inline(entries)).filter(F.col("value").isNotNull())
    return long.groupBy("file", "dim", "value").agg(F.count(F.lit(1)).alias("count"))


def top_k(freq: DataFrame, k: int, by: tuple[str, ...] = (), least: bool = False) -> DataFrame:
    """The most common (or least common) values of every frequency table, ties by value: over all files, or ``by`` file."""
    total = freq.groupBy(*by, "dim", "value").agg(F.sum("count").alias("count"))
    order = F.asc("count") if least else F.desc("count")
    common = Window.partitionBy(*by, "dim").orderBy(order, "value")
    return total.withColumn("rank", F.row_number().over(common)).filter(F.col("rank") <= k)


def cells_with_data(freq: DataFrame) -> DataFrame:
    """Number of one-degree cells that hold a placed document of any file."""
    return freq.filter(F.col("dim") == "cell").select("value").distinct().agg(F.count(F.lit(1)).alias("cells"))


def later_occurrences(rows: DataFrame, kinds: dict[str, list[str]]) -> DataFrame:
    """Per file, one column per kind of key: rows whose key occurred before, in an earlier file or higher up in the
    same one. A key of a single column counts only where it is set.

    Of all rows of a key only the first is no repetition, so rows per (key, file) and the first file of each key are
    enough. Rows are combined before the shuffle; what is left of a key is one row per file. All kinds share one pass.
    """
    columns = list(dict.fromkeys(c for keys in kinds.values() for c in keys))


    def entry(kind: str, keys: list[str]) -> Column:
        used = [F.col(c) if c in keys else F.lit(None).cast(rows.schema[c].dataType) for c in columns]
        key = F.struct(F.lit(kind).alias("kind"), *[u.alias(c) for u, c in zip(used, columns)])
        return key if len(keys) > 1 else F.when(F.col(keys[0]).isNotNull(), key)

    keyed = rows.select("file", F.inline(F.array_compact(F.array(*[entry(k, c) for k, c in kinds.items()]))))
    per_file = keyed.groupBy("kind", *columns, "file").agg(F.count(F.lit(1)).alias("n"))
    first = F.col("file") == F.min("file").over(Window.partitionBy("kind", *columns))
    later = per_file.withColumn("later", F.col("n") - F.when(first, 1).otherwise(0))
    return later.groupBy("file").agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("later"))), F.lit(0)).alias(kind) for kind in kinds])


def profile_dups(rows: DataFrame) -> DataFrame:
    """Per file: repeated record ids and repeated events (species, coordinates, date)."""
    return later_occurrences(rows.filter(F.col("status") == "doc"), {"dup_id": ["oid"], "dup_event": EVENT})


def profile_sample(rows: DataFrame, n: int) -> DataFrame:
    """Per file: its first ``n`` documents, how many are placed, repeated events within the sample, date range, and the
    estimate of usable rows. The sample is cut from ``rows`` once and written; stage ``rows`` if they are parsed text.
    """
    sample = materialize(parsed_prefix(rows, n), "sample")
    stats = sample.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("category") == "ok").alias("coords_ok"),
        F.min("date").alias("date_min"), F.max("date").alias("date_max"))
    both = stats.join(later_occurrences(sample, {"dup_event": EVENT}), "file")
    return both.withColumn("usable", F.col("coords_ok") - F.col("dup_event"))


def profile_offsets(rows: DataFrame) -> DataFrame:
    """Offsets of dated rows, and those that are no multiple of 15 minutes."""
    dated = rows.filter(F.col("date").isNotNull())
    return dated.agg(
        F.count("offset").alias("offsets"), F.count_if(F.col("offset") % 15 != 0).alias("odd_offsets"))


def bad_examples(rows: DataFrame, k: int = 3) -> DataFrame:
    """The first broken lines of every file, cut to 120 characters."""
    in_order = Window.partitionBy("file").orderBy("block", "seq")
    broken = rows.filter(F.col("status") == "invalid").select(*POSITION, "value")
    return broken.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= k) \
        .select("file", "rank", F.substring(F.btrim("value"), 1, 120).alias("example"))
