"""Regex rules as data: every text against every rule, the best one wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from lectern.functions.text import blank_to_null, count_mode, extract, require_columns

#: Rules that one expression takes; more are joined.
MOST_RULES = 200
# The headers of a rule sheet.
LABEL, TECH_KEY, OPERATION, COUNTED = "AKTYWNOSC", "KLUCZ_TECHNICZNY", "OPERACJA", "LICZYC_DO_RAPORTU"
MATCH, USER, OBJECT, PRIORITY, MODE = "REGEX_DOPASOWANIA_(Opis)", "REGEX_USER_ID_(Opis)", "REGEX_OBIEKT_ID_(z dopasowania)", "PRIORYTET", "TRYB_LICZENIA"
IDS = ["teacher_id", "object_id"]


def _java(pattern: Column) -> Column:
    """Python's spelling of named groups as Java has it."""
    return blank_to_null(F.replace(pattern, F.lit("(?P<"), F.lit("(?<")))


def _groups(pattern: Column) -> Column:
    return F.regexp_count(pattern, F.lit(r"(?<!\\)\((?!\?)|\(\?<[a-zA-Z]"))


def compile_rules(sheet: DataFrame, order: str) -> DataFrame:
    """Rule table from a sheet of text columns; `order` is the column that numbers its rows.

    Rows without pattern or key go. Priority is 0 if unreadable and 1 for all if there is no such column;
    the mode column, if any, sets object-based. The group of an id is `id` if so named, else the first; an object
    pattern without group gives none.
    """
    names = require_columns(sheet.columns, [LABEL, TECH_KEY, OPERATION, COUNTED, MATCH, USER, OBJECT])
    has = lambda c: c in sheet.columns
    col = lambda c: F.col(f"`{names[c]}`")
    user = _java(col(USER))
    before_id = F.regexp_extract(user, r"(?s)^(.*?)\(\?<id>", 1)
    mode = count_mode(col(COUNTED))
    if has(MODE):
        mode = F.when(F.lower(F.trim(F.col(f"`{MODE}`"))) == "object-based", "object-based").otherwise(mode)
    return (
        sheet.select(
            F.col(order).cast("int").alias("rule_no"),
            F.trim(col(LABEL)).alias("activity_label"),
            blank_to_null(col(TECH_KEY)).alias("tech_key"),
            F.upper(F.trim(col(OPERATION))).alias("operation"),
            mode.alias("count_mode"),
            (F.coalesce(F.col(f"`{PRIORITY}`").try_cast("int"), F.lit(0)) if has(PRIORITY) else F.lit(1)).alias("priority"),
            _java(col(MATCH)).alias("match_rx"),
            user.alias("user_rx"),
            F.when(user.contains("(?<id>"), _groups(before_id) + 1).when(_groups(user) > 0, 1).alias("user_group"),
            _java(col(OBJECT)).alias("object_rx"),
            F.when(_groups(_java(col(OBJECT))) > 0, 1).alias("object_group"),
        )
        .filter("match_rx is not null and tech_key is not null")
    )


def _id(text: Column, rules: Sequence[Row], kind: str, flag: str, string_ids: bool) -> Column:
    """The id that the winner's own pattern finds in the text."""
    found = F.lit(None).cast("string")
    for r in rules:
        pattern, group = r[f"{kind}_rx"], r[f"{kind}_group"]
        if kind == "object" and not pattern and _has_group(r["match_rx"]):
            pattern, group = r["match_rx"], 1
        if pattern and (group or string_ids):
            found = F.when(F.col("rule_no") == r["rule_no"], extract(text, flag + pattern, group or 0)).otherwise(found)
    return found if string_ids else found.try_cast("long")


def _has_group(pattern: str) -> bool:
    import re

    return re.search(r"(?<!\\)\((?!\?)|\(\?<[a-zA-Z]", pattern) is not None


def match_rules(
    events: DataFrame,
    rules: DataFrame,
    text: str,
    *,
    case_sensitive: bool = False,
    string_ids: bool = False,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Add the winning rule of each text: the greatest priority, the earliest row among equals.

    Adds rule_no, priority, n_matches, n_best (over 1: a conflict), activity_label, tech_key, operation,
    count_mode, teacher_id, object_id. Rows that no rule matches go, or stay with nulls. Each rule is
    an expression of its own with a constant pattern, so there is neither join nor shuffle; a table of
    more than 200 rules is refused (see `match_rules_joined`).
    """
    table = rules.orderBy("rule_no").limit(MOST_RULES + 1).collect()
    if len(table) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules; use match_rules_joined")
    flag, t = "" if case_sensitive else "(?i)", F.col(text)
    fields = ["activity_label", "tech_key", "operation", "count_mode"]

    def hit(r: Row) -> Column:
        best_first = [F.lit(r["priority"]).cast("int").alias("priority"), F.lit(-r["rule_no"]).cast("int").alias("turn")]
        return F.when(t.rlike(flag + r["match_rx"]), F.struct(*best_first, *[F.lit(r[f]).cast("string").alias(f) for f in fields]))

    kind = "array<struct<priority:int,turn:int,activity_label:string,tech_key:string,operation:string,count_mode:string>>"
    hits = F.array_compact(F.array(*[hit(r) for r in table]).cast(kind)) if table else F.array().cast(kind)
    # Behind the explode of one element no filter moves below the matching, so each pattern runs once a text.
    found = events.withColumn("_hits", hits)
    found = found.select("*", F.explode(F.array(F.array_max("_hits"))).alias("_best"))
    if not keep_unmatched:
        found = found.filter("_best is not null")
    found = found.select(
        *events.columns,
        (-F.col("_best.turn")).alias("rule_no"),
        F.col("_best.priority").alias("priority"),
        F.size("_hits").alias("n_matches"),
        F.size(F.filter("_hits", lambda h: h["priority"] == F.col("_best.priority"))).alias("n_best"),
        *[F.col(f"_best.{f}").alias(f) for f in fields],
        F.transform(F.filter("_hits", lambda h: h["priority"] == F.col("_best.priority")), lambda h: -h["turn"]).alias("best_rules"),
    )
    return found.withColumns({"teacher_id": _id(t, table, "user", flag, string_ids), "object_id": _id(t, table, "object", flag, string_ids)})


def match_rules_joined(events: DataFrame, rules: DataFrame, text: str, key: Sequence[str], case_sensitive: bool = False) -> DataFrame:
    """(key, rule_no, priority, n_matches, n_best) of each matched text; every pattern is tried on every text.

    For thousands of rules see `rule_index.match_rules_indexed`. The rules side decides the plan: Spark broadcasts it only below its own limit. One aggregate by key follows.
    """
    pattern = F.concat(F.lit("" if case_sensitive else "(?i)"), F.col("match_rx"))
    return winners(events.select(*key, text).join(rules.select("rule_no", "priority", "match_rx"), F.expr("true") & F.rlike(F.col(text), pattern)), key)


def winners(pairs: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, rule_no, priority, n_matches, n_best) of matching pairs (key, rule_no, priority): the greatest priority, the smallest rule_no of it."""
    counted = pairs.groupBy(*key, "priority").agg(F.count("*").alias("n"), F.min("rule_no").alias("rule_no"))
    return (
        counted.groupBy(*key)
        .agg(F.max(F.struct("priority", "rule_no", "n")).alias("best"), F.sum("n").alias("n_matches"))
        .select(*key, F.col("best.rule_no").alias("rule_no"), F.col("best.priority").alias("priority"), "n_matches", F.col("best.n").alias("n_best"))
    )


def countable(matched: DataFrame) -> DataFrame:
    """Events whose winner is counted. A winner NIE drops the event, whatever lower rules say."""
    return matched.filter(F.coalesce(F.col("count_mode"), F.lit("")) != "NIE")


def conflicts(matched: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, priority, best_rules) where several rules share the winning priority."""
    return matched.filter("n_best > 1").select(*key, "priority", F.array_sort("best_rules").alias("best_rules"))
