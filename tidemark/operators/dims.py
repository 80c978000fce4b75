"""Dimensions: calendar, special members, type 1, type 2, junk and location."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.compare import CheckFailed, differs, fail_if, lookup
from tidemark.functions.dates import OPEN_END, date_key, month_name
from tidemark.operators.segments import numbered, segmented

#: The special members of every dimension.
SPECIAL = ((0, "Missing"), (-1, "Unknown"), (-2, "Not Applicable"))
MAX_DAYS = 10_000


def dim_date(spark: SparkSession, start: date, end: date, complete_through: date) -> DataFrame:
    """Whole calendar years, one row per day, plus the three special members."""
    if (start.month, start.day) != (1, 1) or (end.month, end.day) != (12, 31) or end < start:
        raise CheckFailed("the date range must be whole calendar years")
    if (end - start).days + 1 > MAX_DAYS:
        raise CheckFailed(f"the date range exceeds {MAX_DAYS} days")
    if not (start.toordinal() - 1 <= complete_through.toordinal() <= end.toordinal()):
        raise CheckFailed("complete_through must lie within the range")
    first = F.lit(start)
    days = spark.range((end - start).days + 1).select(F.date_add(first, F.col("id").cast("int")).alias("d"))
    return days_with_specials(days, F.lit(complete_through))


def days_with_specials(days: DataFrame, complete_through: Column) -> DataFrame:
    """The calendar columns for a frame of distinct days `d`, plus the special members."""
    d = F.col("d")
    name = month_name(d)
    rows = days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_label"),
        F.month(d).alias("month_number"),
        name.alias("month_name"),
        (F.year(d) * 100 + F.month(d)).alias("year_month_number"),
        F.concat_ws(" ", F.left(name, F.lit(3)), F.year(d).cast("string")).alias("year_month_label"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.last_day(d) <= complete_through).alias("is_complete_month"),
    )
    labels = ("quarter_label", "month_name", "year_month_label")
    spark = days.sparkSession
    special = spark.createDataFrame(
        [tuple(k if f.name == "date_key" else text if f.name in labels
               else False if f.name == "is_complete_month" else None for f in rows.schema.fields)
         for k, text in SPECIAL],
        T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields]))
    return rows.unionByName(special)


def dim_calendar(dates: DataFrame) -> DataFrame:
    """The date dimension without its special members."""
    return dates.where(F.col("date_key") > 0)


def calendar_problems(calendar: DataFrame) -> DataFrame:
    """One row of counts that must all be zero for a valid date table."""
    c = F.col("full_date")
    span = F.datediff(F.max(c), F.min(c)) + 1
    return calendar.agg(
        (span - F.count(F.lit(1))).alias("missing_days"),
        (F.count(F.lit(1)) - F.countDistinct(c)).alias("repeated_days"),
        F.count_if(date_key(c) != F.col("date_key")).alias("wrong_keys"))


def with_special_members(members: DataFrame, key: str) -> DataFrame:
    """members plus the three special rows: their text says which, the rest is NULL or open.

    Existing special members are kept; only some of them present is an error.
    """
    have = members.where(F.col(key) <= 0).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if have == len(SPECIAL):
        return members
    if have:
        raise CheckFailed(f"{have} of {len(SPECIAL)} special members present")
    return members.unionByName(special_rows(members, key))


def special_rows(like: DataFrame, key: str) -> DataFrame:
    """The three special members in like's schema."""
    fixed = {"valid_from_date_key": 0, "valid_to_date_key": OPEN_END, "is_current": True, "is_deleted": False,
             "version_reason": "Special member"}

    def value(field: T.StructField, number: int, text: str):
        if field.name == key:
            return number
        if field.name in fixed:
            return fixed[field.name]
        return text if isinstance(field.dataType, T.StringType) and not field.name.endswith("_code") else None

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in like.schema.fields])
    return like.sparkSession.createDataFrame(
        [tuple(value(f, k, text) for f in schema.fields) for k, text in SPECIAL], schema)


def next_keys(dim: DataFrame | None, key: str) -> Column | int:
    """Where new surrogate keys start: after the greatest ever used."""
    if dim is None:
        return 0
    return F.greatest(dim.agg(F.coalesce(F.max(key), F.lit(0)).alias("k")).scalar(), F.lit(0))


def check_source(source: DataFrame, id_column: str, required: Sequence[str] = ("is_deleted_in_source",)) -> None:
    """Duplicate ids and missing flags stop a dimension load. One aggregate, one row."""
    row = source.agg(
        (F.count(F.lit(1)) - F.countDistinct(id_column)).alias("repeated"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
    if row["repeated"]:
        raise CheckFailed(f"{row['repeated']} rows repeat a {id_column}")
    for c in required:
        if row[c]:
            raise CheckFailed(f"{row[c]} rows have no {c}")


def deletion_counts(dim: DataFrame, source: DataFrame, id_column: str, key: str) -> DataFrame:
    """One row for the mass-delete guard: active_before and deleted members."""
    current = dim.where((F.col(key) > 0) & F.col("is_current"))
    src = source.select(id_column, F.col("is_deleted_in_source").alias("_gone"))
    joined = current.join(src, id_column, "left")
    gone = F.coalesce("_gone", F.lit(True))
    return joined.agg(F.count_if(~F.col("is_deleted")).alias("active_before"),
                      F.count_if(~F.col("is_deleted") & gone).alias("deleted"))


def scd1_upsert(dim: DataFrame | None, source: DataFrame, id_column: str, key: str, attributes: Sequence[str],
                first_key: int | Column) -> DataFrame:
    """Type 1: attributes overwritten on every row of a member, new members from first_key.

    A member flagged in the source, or absent from it, is marked deleted; none is removed.
    """
    first = F.lit(first_key) if isinstance(first_key, int) else first_key
    fresh = source if dim is None else source.join(
        dim.where(F.col(key) > 0).select(id_column), id_column, "left_anti")
    new = numbered(fresh, [id_column], key, next_keys(dim, key)).select(
        key, id_column, *attributes, first.cast("int").alias("valid_from_date_key"),
        F.lit(OPEN_END).alias("valid_to_date_key"), F.lit(True).alias("is_current"),
        F.col("is_deleted_in_source").alias("is_deleted"), F.lit("Initial version").alias("version_reason"))
    if dim is None:
        return new.unionByName(special_rows(new, key))
    src = source.select(id_column, F.struct(*attributes).alias("_s"), F.col("is_deleted_in_source").alias("_gone"))
    present = F.col("_s").isNotNull() & (F.col(key) > 0)
    updated = dim.join(src, id_column, "left").select(
        key, id_column,
        *[F.when(present, F.col(f"_s.{a}")).otherwise(F.col(a)).alias(a) for a in attributes],
        "valid_from_date_key", "valid_to_date_key", "is_current",
        F.when(F.col(key) <= 0, F.col("is_deleted")).otherwise(F.coalesce("_gone", F.lit(True))).alias("is_deleted"),
        "version_reason")
    return updated.unionByName(new)


def backdated(dim: DataFrame, source: DataFrame, id_column: str, key: str, type2: Sequence[str]) -> DataFrame:
    """Members whose change would start before the version it replaces."""
    current = dim.where((F.col(key) > 0) & F.col("is_current"))
    src = source.select(id_column, F.struct(*type2).alias("_s"), "source_changed_date_key")
    changed = differs([F.col(a) for a in type2], [F.col(f"_s.{a}") for a in type2])
    return current.join(src, id_column).where(
        changed & (F.col("valid_from_date_key") > F.col("source_changed_date_key")))


def scd2_apply(dim: DataFrame | None, source: DataFrame, id_column: str, key: str, type1: Sequence[str],
               type2: Sequence[str], first_key: int | Column, label: str | None = None,
               label_of: Sequence[str] = (), reasons: dict[str, str] | None = None) -> DataFrame:
    """Type 2: the next state of a versioned dimension.

    Type 1 attributes and the deletion flag are written on all versions of a member. A
    type 2 change on the current version's own start date overwrites it in place; a later
    one expires the version and opens [change date, open end). New members start at
    first_key. Run `backdated` first; its rows are an error.
    """
    reasons = reasons or {a: a for a in type2}
    first = F.lit(first_key) if isinstance(first_key, int) else first_key
    layout = [key, id_column, *type1, *type2, *([label] if label else []), "valid_from_date_key",
              "valid_to_date_key", "is_current", "is_deleted", "version_reason"]

    def labelled(df: DataFrame) -> DataFrame:
        if label is None:
            return df
        own = F.concat(F.col(id_column).cast("string"), F.lit(" "), F.col(label_of[0]), F.lit(" ("),
                       F.concat_ws(", ", *[F.col(c) for c in label_of[1:]]), F.lit(")"))
        return df.withColumn(label, own)

    def opened(df: DataFrame, since: Column, reason: Column) -> DataFrame:
        return df.select(id_column, *type1, *type2, since.cast("int").alias("valid_from_date_key"),
                         F.lit(OPEN_END).alias("valid_to_date_key"), F.lit(True).alias("is_current"),
                         F.col("is_deleted_in_source").alias("is_deleted"), reason.alias("version_reason"))

    if dim is None:
        new = labelled(opened(source, first, F.lit("Initial version")))
        keyed = numbered(new, [id_column, "valid_from_date_key"], key).select(*layout)
        return keyed.unionByName(special_rows(keyed, key))

    src = source.select(id_column, F.struct(*type1, *type2).alias("_s"),
                        F.col("is_deleted_in_source").alias("_gone"), "source_changed_date_key")
    members = dim.where(F.col(key) > 0)
    change = F.col("source_changed_date_key")
    # Marked once; every branch below reads the marks.
    marked = members.join(src, id_column, "left").withColumn(
        "_changed", F.col("_s").isNotNull() & F.col("is_current")
        & differs([F.col(a) for a in type2], [F.col(f"_s.{a}") for a in type2])
    ).withColumn("_expire", F.col("_changed") & (F.col("valid_from_date_key") < change)
    ).withColumn("_overwrite", F.col("_changed") & (F.col("valid_from_date_key") == change))
    present = F.col("_s").isNotNull()
    existing = labelled(marked.select(
        key, id_column,
        *[F.when(present, F.col(f"_s.{a}")).otherwise(F.col(a)).alias(a) for a in type1],
        *[F.when(F.col("_overwrite"), F.col(f"_s.{a}")).otherwise(F.col(a)).alias(a) for a in type2],
        "valid_from_date_key",
        F.when(F.col("_expire"), change).otherwise(F.col("valid_to_date_key")).alias("valid_to_date_key"),
        (F.col("is_current") & ~F.col("_expire")).alias("is_current"),
        F.coalesce("_gone", F.lit(True)).alias("is_deleted"), "version_reason"))

    why = F.concat(F.lit("Changed:"), *[
        F.when(~F.col(a).eqNullSafe(F.col(f"_s.{a}")), F.lit(f" {reasons[a]}")).otherwise("") for a in type2])
    reopened = marked.where("_expire").select(
        id_column, *[F.col(f"_s.{a}").alias(a) for a in [*type1, *type2]],
        change.cast("int").alias("valid_from_date_key"), F.lit(OPEN_END).alias("valid_to_date_key"),
        F.lit(True).alias("is_current"), F.coalesce("_gone", F.lit(True)).alias("is_deleted"),
        why.alias("version_reason"))
    arrived = opened(source.join(members.select(id_column), id_column, "left_anti"), first,
                     F.lit("Initial version"))
    new = numbered(labelled(reopened.unionByName(arrived)), [id_column, "valid_from_date_key"], key,
                   next_keys(dim, key))
    special = dim.where(F.col(key) <= 0)
    return (existing.select(*layout).unionByName(new.select(*layout)).unionByName(special.select(*layout)))


def scd2_from_history(history: DataFrame, id_column: str, attributes: Sequence[str], date_column: str) -> DataFrame:
    """Versions straight from a full history: islands of equal attributes, half-open.

    history has one row per (id, date_column), an int date key; values may repeat.
    """
    rows = segmented(history.select(id_column, date_column, *attributes), [id_column], [date_column],
                     lag={"_before": F.struct(*attributes)})
    starts = rows.where(F.col("_before").isNull() | differs(
        [F.col(a) for a in attributes], [F.col(f"_before.{a}") for a in attributes])).drop("_before")
    # The next start of a key is the previous one on the reversed order.
    closed = segmented(starts.withColumn("_reversed", -F.col(date_column)), [id_column], ["_reversed"],
                       lag={"_next": F.col(date_column)})
    return closed.select(
        id_column, *attributes, F.col(date_column).alias("valid_from_date_key"),
        F.coalesce("_next", F.lit(OPEN_END)).alias("valid_to_date_key"),
        F.col("_next").isNull().alias("is_current"))


def junk_dim(dim: DataFrame | None, source: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Distinct combinations that occur; new ones are added, none ever changes."""
    combos = source.select(*columns).distinct()
    if dim is None:
        new = numbered(combos, list(columns), key).select(key, *columns)
        return new.unionByName(special_rows(new, key))
    fresh = combos.join(dim.where(F.col(key) > 0).select(*columns), list(columns), "left_anti")
    return dim.unionByName(numbered(fresh, list(columns), key, next_keys(dim, key)).select(*dim.columns))


def city_state_map(*sources: DataFrame) -> DataFrame:
    """City to state, only where all sources agree on one; named by the best source.

    Each source has columns city, state, source_rank. Only two aggregate values are kept
    per city: the least and the greatest state, equal exactly when there is one.
    """
    pairs = sources[0]
    for other in sources[1:]:
        pairs = pairs.unionByName(other)
    return (
        pairs.where(F.col("city").isNotNull() & F.col("state").isNotNull())
        .groupBy("city").agg(F.min("state").alias("lo"), F.max("state").alias("hi"),
                             F.min("source_rank").alias("state_rank"))
        .where(F.col("lo") == F.col("hi"))
        .select(F.col("city").alias("location_city"), F.col("lo").alias("location_state_code"), "state_rank"))


#: Which source a rank stands for.
STATE_SOURCES = {1: "silver_facilities", 2: "silver_routes", 3: "silver_delivery_events"}


def dim_location(dim: DataFrame | None, cities: DataFrame, city_map: DataFrame, states: DataFrame) -> DataFrame:
    """Cities that occur in events and resolve to one state; insert-only."""
    named = (
        cities.join(city_map, "location_city")
        .join(states.select(F.col("state_code").alias("location_state_code"), "state_name"),
              "location_state_code", "left")
        .select("location_city", "location_state_code",
                F.coalesce("state_name", F.lit("Unknown")).alias("location_state_name"),
                F.lit("United States").alias("location_country"),
                lookup(STATE_SOURCES, F.col("state_rank")).alias("state_source")))
    key = "location_key"
    if dim is None:
        new = numbered(named, ["location_city"], key).select(key, *named.columns)
        return new.unionByName(special_rows(new, key))
    fresh = named.join(dim.where(F.col(key) > 0).select("location_city"), "location_city", "left_anti")
    return dim.unionByName(numbered(fresh, ["location_city"], key, next_keys(dim, key)).select(*dim.columns))


#: The 50 states and the federal district.
US_STATES = {
    "AL": "Alabama",
    "AK": "Alaska",
    "AZ": "Arizona",
    "AR": "Arkansas",
    "CA": "California",
    "CO": "Colorado",
    "CT": "Connecticut",
    "DE": "Delaware",
    "DC": "District of Columbia",
    "FL": "Florida",
    "GA": "Georgia",
    "HI": "Hawaii",
    "ID": "Idaho",
    "IL": "Illinois",
    "IN": "Indiana",
    "IA": "Iowa",
    "KS": "Kansas",
    "KY": "Kentucky",
    "LA": "Louisiana",
    "ME": "Maine",
    "MD": "Maryland",
    "MA": "Massachusetts",
    "MI": "Michigan",
    "MN": "Minnesota",
    "MS": "Mississippi",
    "MO": "Missouri",
    "MT": "Montana",
    "NE": "Nebraska",
    "NV": "Nevada",
    "NH": "New Hampshire",
    "NJ": "New Jersey",
    "NM": "New Mexico",
    "NY": "New York",
    "NC": "North Carolina",
    "ND": "North Dakota",
    "OH": "Ohio",
    "OK": "Oklahoma",
    "OR": "Oregon",
    "PA": "Pennsylvania",
    "RI": "Rhode Island",
    "SC": "South Carolina",
    "SD": "South Dakota",
    "TN": "Tennessee",
    "TX": "Texas",
    "UT": "Utah",
    "VT": "Vermont",
    "VA": "Virginia",
    "WA": "Washington",
    "WV": "West Virginia",
    "WI": "Wisconsin",
    "WY": "Wyoming",
}


def us_states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(US_STATES.items()), "state_code string, state_name string")


def assert_not_backdated(dim: DataFrame, source: DataFrame, id_column: str, key: str,
                         type2: Sequence[str]) -> None:
    fail_if(backdated(dim, source, id_column, key, type2), f"{id_column}: a change precedes the current version")
