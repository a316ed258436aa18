"""Data-quality reports: declared keys, references and domains."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Rows of ``child`` whose foreign key has a value with no parent."""
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


# The declared references as (child, foreign key, parent, primary key).
REFERENCES = (
    ("policies", "customer_id", "customers", "customer_id"),
    ("vehicles", "policy_id", "policies", "policy_id"),
    ("drivers", "policy_id", "policies", "policy_id"),
    ("accidents", "policy_id", "policies", "policy_id"),
    ("accidents", "vehicle_id", "vehicles", "vehicle_id"),
    ("accidents", "driver_id", "drivers", "driver_id"),
    ("claims", "accident_id", "accidents", "accident_id"),
    ("safe_driver_scores", "driver_id", "drivers", "driver_id"),
)

# The declared primary keys.
PRIMARY_KEYS = {
    "customers": ["customer_id"], "policies": ["policy_id"], "vehicles": ["vehicle_id"],
    "drivers": ["driver_id"], "accidents": ["accident_id"], "claims": ["claim_id"],
    "safe_driver_scores": ["score_id"], "driver_behavior_features": ["driver_id"],
}


def orphan_report(tables: dict[str, DataFrame], references=REFERENCES) -> DataFrame:
    """Orphan rows and distinct orphan keys for each reference whose tables are given.

    Each child is read once: grouping sets over its foreign keys reduce it to one row per
    reference and key, so a key repeated in a large share of the rows crosses the network once
    per task. Each parent is read once, too, and all references share one anti join.
    """
    given = {f"{c}.{fk} -> {p}.{pk}": (c, fk, p, pk) for c, fk, p, pk in references if c in tables and p in tables}
    keyed, parents = [], []
    for child in dict.fromkeys(c for c, *_ in given.values()):
        mine = [(name, fk) for name, (c, fk, *_) in given.items() if c == child]
        columns = [f"_k{i}" for i in range(len(mine))]
        rows = tables[child].select(*[F.col(fk).cast("string").alias(c) for c, (_, fk) in zip(columns, mine)])
        # The grouping id has a zero only for the column of its set; the first column is the highest bit.
        every, reference = (1 << len(mine)) - 1, F.lit(None).cast("string")
        for i, (name, _) in enumerate(mine):
            reference = F.when(F.col("_set") == (every ^ (1 << (len(mine) - 1 - i))), name).otherwise(reference)
        keyed.append(
            rows.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns])
            .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_set"))
            .select(reference.alias("reference"), F.coalesce(*columns).alias("key"), "n")
            .where(F.col("key").isNotNull()))
    for parent, pk in dict.fromkeys((p, pk) for *_, p, pk in given.values()):
        names = F.array(*[F.lit(name) for name, (*_, p, k) in given.items() if (p, k) == (parent, pk)])
        parents.append(tables[parent].select(F.explode(names).alias("reference"), F.col(pk).cast("string").alias("key")))
    lost = _stacked(keyed).join(_stacked(parents), ["reference", "key"], "left_anti").groupBy("reference").agg(
        F.sum("n").alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys"))
    names = next(iter(tables.values())).sparkSession.createDataFrame([(name,) for name in given], "reference STRING")
    return names.join(lost, "reference", "left").fillna(0, ["orphan_rows", "orphan_keys"])


def duplicates(df: DataFrame, pk: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def duplicate_report(tables: dict[str, DataFrame], keys: dict[str, list[str]] = PRIMARY_KEYS) -> DataFrame:
    """Duplicate keys and surplus rows per table."""
    reports = []
    for name, df in tables.items():
        if name in keys:
            reports.append(
                duplicates(df, keys[name])
                .agg(F.count(F.lit(1)).alias("duplicate_keys"),
                     F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"))
                .select(F.lit(name).alias("table_name"), "duplicate_keys", "surplus_rows")
            )
    return _stacked(reports)


@dataclass(frozen=True)
class Rule:
    """A named condition that a valid row does not meet."""

    column: str
    check: str
    broken: Column


def required(column: str) -> Rule:
    return Rule(column, "not null", F.col(column).isNull())


def one_of(column: str, *values: str) -> Rule:
    """NULL passes, as it does in a CHECK constraint."""
    return Rule(column, "in " + "/".join(values), ~F.col(column).isin(*values))


def at_most(column: str, length: int) -> Rule:
    return Rule(column, f"length <= {length}", F.char_length(column) > length)


def fits(column: str, precision: int, scale: int) -> Rule:
    """A number that a column NUMERIC(precision, scale) can hold."""
    return Rule(column, f"numeric({precision},{scale})", F.abs(F.col(column)) >= 10 ** (precision - scale))


def exactly(column: str, length: int) -> Rule:
    return Rule(column, f"length = {length}", F.char_length(column) != length)


# The declared columns as (not null, lengths), and further conditions.
DECLARED = {
    "customers": ("customer_id first_name last_name email",
                  {"first_name": 50, "last_name": 50, "email": 255, "phone_number": 20, "address": 255,
                   "city": 100, "state": 2, "zip_code": 10}),
    "policies": ("policy_id customer_id policy_number start_date end_date", {"policy_number": 20, "status": 20}),
    "vehicles": ("vehicle_id policy_id vin make model year", {"make": 50, "model": 50, "color": 30}),
    "drivers": ("driver_id policy_id first_name last_name date_of_birth license_number",
                {"first_name": 50, "last_name": 50, "license_number": 20}),
    "accidents": ("accident_id policy_id vehicle_id driver_id accident_timestamp", {}),
    "claims": ("claim_id accident_id claim_date", {"status": 20}),
    "safe_driver_scores": ("score_id driver_id score calculation_date", {}),
}


def declared_rules() -> dict[str, list[Rule]]:
    """Rules that follow from the declared columns, per table."""
    more = {
        "policies": [one_of("status", "ACTIVE", "EXPIRED", "CANCELLED")],
        "vehicles": [exactly("vin", 17)],
        "accidents": [fits("latitude", 10, 7), fits("longitude", 10, 7), fits("g_force", 4, 2)],
        "claims": [one_of("status", "PENDING", "APPROVED", "DENIED"), fits("amount", 10, 2)],
        "safe_driver_scores": [fits("score", 5, 2)],
    }
    return {table: [*map(required, names.split()), *[at_most(c, n) for c, n in lengths.items()], *more.get(table, [])]
            for table, (names, lengths) in DECLARED.items()}


def domain_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows breaking each rule, all counted in one pass over the table. A rule on a column that
    the table lacks has a line, too, without a number."""
    def broken(i: int, rule: Rule) -> Column:
        counted = F.count_if(rule.broken) if rule.column in df.columns else F.lit(None).cast("bigint")
        return counted.alias(f"broken_{i}")

    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[broken(i, rule) for i, rule in enumerate(rules)])
    lines = F.array(*[
        F.struct(F.lit(rule.column).alias("column_name"), F.lit(rule.check).alias("rule"),
                 F.col(f"broken_{i}").alias("broken_rows"), F.col("rows").alias("checked_rows"))
        for i, rule in enumerate(rules)
    ])
    return counted.select(F.inline(lines))


def fingerprint(df: DataFrame) -> DataFrame:
    """Number of rows and an order-free checksum over all columns."""
    return df.agg(*fingerprint_columns(df.columns))


def fingerprint_columns(columns: list[str]) -> list[Column]:
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(columns)]).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(whole), F.lit(0)).cast("decimal(38,0)").alias("checksum")]


def rows_match(before: DataFrame, after: DataFrame, *by: str) -> DataFrame:
    """Rows and checksums of two datasets side by side, per ``by`` group if given."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*by).agg(*fingerprint_columns(df.columns)).withColumn("side", F.lit(name))

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col(column))).alias(f"{column}_{name}")

    return (
        side(before, "before").unionByName(side(after, "after")).groupBy(*by)
        .agg(of("before", "rows"), of("after", "rows"), of("before", "checksum"), of("after", "checksum"))
        .withColumn("matches", F.col("rows_before").eqNullSafe(F.col("rows_after"))
                    & F.col("checksum_before").eqNullSafe(F.col("checksum_after")))
    )


def _stacked(reports: list[DataFrame]) -> DataFrame:
    out = reports[0]
    for report in reports[1:]:
        out = out.unionAll(report)
    return out
