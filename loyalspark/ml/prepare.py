"""Model-table preparation: M7-M15.

The feature policy (M10) assigns every ABT column to a group that decides
its type and how missing values are filled:

* categorical states                      -> constant "non-user" label
* course shares                           -> 0 (course not taken)
* "bigger is better" integers / doubles   -> 0 (worst case)
* "smaller is better" (gaps, recency, means) -> 1000 (worst case)
* age in days                             -> row excluded when missing

All steps are column expressions over the DataFrame; the policy itself is a
small driver-side list of rules.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalspark.config import NON_USER_MAIN
from loyalspark.functions.expr import hash_order
from loyalspark.operators.profile import null_rates

KEY_COLUMNS = ("ref_date", "user_id", "label", "tag", "cutoff", "customer_id", "user")


@dataclass(frozen=True)
class Rule:
    group: str
    pattern: str
    action: str
    fill: object
    dtype: str
    note: str


POLICY = (
    Rule("categorical", r"^state_(current|d28)$", "fill_missing", NON_USER_MAIN, "string",
         "user did not exist at that snapshot"),
    Rule("courses", r"^share_brand_|^share_(?!cat_|prod_)", "zero", 0.0, "double",
         "0 = course not taken"),
    Rule("to_1000", r"^(gap_mean_|avg_freq_|days_since_activity$)", "fill_1000", 1000.0, "double",
         "smaller is better; 1000 = worst case"),
    Rule("exclude", r"^age_days$", "exclude_row", None, "double",
         "missing age means no history: row excluded"),
    Rule("int_to_zero", r"^(frequency|active_days_|tx_(life|d\d+|morning|afternoon|night)$|pts_|n_complete|n_in_progress)",
         "zero", 0, "long", "bigger is better; 0 = worst case"),
    Rule("float_to_zero", r"^(tx_per_day_|pct_|ratio_freq_|hours_|share_cat_|share_prod_)", "zero", 0.0, "double",
         "bigger is better; 0 = worst case"),
)


def rule_for(column: str) -> Rule | None:
    for r in POLICY:
        if re.search(r.pattern, column):
            return r
    return None


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in KEY_COLUMNS]


def cast_by_policy(df: DataFrame) -> DataFrame:
    """Cast every policy-covered column to its type (absent ones skipped)."""
    cols = []
    for c in df.columns:
        r = rule_for(c)
        cols.append(F.col(f"`{c}`").cast(r.dtype).alias(c) if r and c not in KEY_COLUMNS else F.col(f"`{c}`"))
    return df.select(*cols)


def impute(df: DataFrame, non_user: str = NON_USER_MAIN) -> DataFrame:
    """Constant imputation by policy; rows with a missing excluded
    feature are dropped."""
    fills = {}
    excl = []
    for c in feature_columns(df):
        r = rule_for(c)
        if r is None:
            continue
        if r.action == "exclude_row":
            excl.append(c)
        elif r.group == "categorical":
            fills[c] = non_user
        else:
            fills[c] = r.fill
    out = df.dropna(subset=excl) if excl else df
    return out.na.fill(fills) if fills else out


def drop_uninformative(df: DataFrame, label: str = "label", drop_null: bool = True) -> tuple:
    """Drop numeric features whose label-wise median ratio is 1 (and
    NULL, main variant). Returns (reduced DataFrame, dropped feature list);
    the ratios come from one aggregate job."""
    from loyalspark.operators.profile import label_median_ratio, numeric_columns, uninformative
    cols = [c for c in numeric_columns(df, exclude=KEY_COLUMNS)]
    if not cols:
        return df, []
    drop = [r[0] for r in uninformative(label_median_ratio(df, label, cols), drop_null).collect()]
    return df.drop(*drop), drop


def feature_profile(df: DataFrame) -> DataFrame:
    """M9: null rate per feature joined with its policy group and action."""
    cols = feature_columns(df)
    rates = null_rates(df, cols)
    spark = df.sparkSession
    rows = []
    for c in cols:
        r = rule_for(c)
        rows.append((c, *((r.group, r.action, r.dtype, r.note, POLICY.index(r) + 1) if r else (None,) * 5)))
    pol = spark.createDataFrame(rows, "feature string, policy_group string, action string, dtype string, note string, step int")
    return (rates.join(pol, "feature", "left")
            .withColumn("has_null", F.col("null_rate") > 0))


def stratified_split(df: DataFrame, label: str = "label", test_fraction: float = 0.2, seed: int = 42,
                     keys=("user_id", "ref_date")) -> DataFrame:
    """M7: deterministic stratified split. Within each label the rows are
    ordered by an md5 of (seed, keys), and the first ``test_fraction`` of them
    (rounded) are the test rows, so every label has the same share.

    The place of a row in its label's order is counted in two steps, first the
    rows per label and leading hash digits (65,536 cells), then the order
    inside a cell, so a label with most rows is no single task.
    """
    h = hash_order(seed, *keys)
    rows = df.withColumn("__h", h).withColumn("__cell", F.substring("__h", 1, 4))
    cells = rows.groupBy(label, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    by_label = Window.partitionBy(label)
    cells = cells.select(
        F.col(label).alias("__label"), F.col("__cell").alias("__c"),
        F.round(F.lit(test_fraction) * F.sum("__n").over(by_label)).alias("__quota"),
        (F.sum("__n").over(by_label.orderBy("__cell")) - F.col("__n")).alias("__before"))
    same = F.col(label).eqNullSafe(F.col("__label")) & (F.col("__cell") == F.col("__c"))
    place = F.row_number().over(Window.partitionBy(label, "__cell").orderBy("__h", *keys)) + F.col("__before")
    return (rows.join(cells, same).withColumn("split", F.when(place <= F.col("__quota"), "test").otherwise("train"))
            .select(*df.columns, "split"))


def policy_stages(columns: dict[str, str], keep: list[str] | None = None, non_user: str = NON_USER_MAIN,
                  on_empty: str = "error") -> list:
    """M11 + M13 + M14 as pipeline stages over raw feature rows: casts every
    feature to its policy type, fills missing values by policy and leaves out
    rows without an excluded feature's value.

    ``columns`` maps the raw features to their types; ``keep`` are those that
    survived ``drop_uninformative`` (all by default; categorical ones always
    stay). ``on_empty`` says what happens when no numeric feature survived:
    ``"error"`` or ``"pass"``. The stages are SQL over the row, so they are
    saved with the model and run inside Spark's own expressions; columns that
    are no features (keys, labels) pass through.
    """
    rules = {c: rule_for(c) for c in columns if rule_for(c)}
    kept = [c for c in rules if keep is None or c in keep or rules[c].group == "categorical"]
    if not [c for c in kept if rules[c].group != "categorical"] and on_empty == "error":
        raise ValueError("no numeric feature survived")
    out, needed = [], []
    for c in rules:
        r, x = rules[c], f"CAST(`{c}` AS {rules[c].dtype})"
        if c not in kept:
            continue
        if r.action == "exclude_row":
            needed.append(f"`{c}` IS NOT NULL")
        else:
            fill = "'" + non_user.replace("'", "''") + "'" if r.group == "categorical" else repr(r.fill)
            x = f"coalesce({x}, CAST({fill} AS {r.dtype}))"
        out.append(f"{x} AS `{c}`")
    if not rules:
        return []
    gone = ", ".join(f"`{c}`" for c in rules)
    sql = f"SELECT * EXCEPT ({gone}){', ' + ', '.join(out) if out else ''} FROM __THIS__"
    return [SQLTransformer(statement=sql + (f" WHERE {' AND '.join(needed)}" if needed else ""))]


def split_oot(df: DataFrame, how: str = "tag", oot_tag: str = "OOT", date_col: str = "ref_date"):
    """M8: (in-time, out-of-time) by tag (main) or by the latest date (refs)."""
    if how == "tag":
        return df.filter(F.col("tag") != oot_tag), df.filter(F.col("tag") == oot_tag)
    last = F.broadcast(df.agg(F.max(date_col).alias(date_col)))
    return df.join(last, date_col, "left_anti"), df.join(last, date_col, "left_semi")


def clean_names(df: DataFrame) -> DataFrame:
    """Column names as plain identifiers (invalid characters -> _). Names
    that would clash, as those of ``a b`` and ``a_b``, are numbered from the
    second on; a name that is plain already keeps it."""
    plain = [re.sub(r"[^0-9A-Za-z_]", "_", str(c)) for c in df.columns]
    taken = {c.lower() for c, p in zip(df.columns, plain) if c == p}
    names = []
    for c, p in zip(df.columns, plain):
        name, n = p, 1
        while c != p and name.lower() in taken:
            n += 1
            name = f"{p}_{n}"
        taken.add(name.lower())
        names.append(name)
    return df.toDF(*names)
