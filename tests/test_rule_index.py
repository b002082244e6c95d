"""Rules found by what their patterns require, against every pattern on every text."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import rule_index, rules

PATTERNS = [
    ("user with id '(\\d+)'", "user with id '"), ("(?<id>\\w+) viewed the", " viewed the"), ("Created|Deleted", None), ("(?:abc|abd)ef", "ab"), ("(abcd)+ef", "abcd"), ("(abcd)?efgh", "efgh"),
    ("ABC\\b DEF", "abc def"), ("^start$", "start"), ("a{3}bcde", "bcde"), ("x*", None), ("\\p{L}+ word", None), ("\\Qa.b\\E", None), ("[a-z&&[^b]]xyzw", None), ("(?i)Word here", "word here"),
    ("(?u)Word", None), ("(?x) a b", None), ("wor(?=d)d it", "word it"), ("(?>atomic) group", "atomic group"), ("a++bcd e", "bcd e"), ("Zażółć", "zażółć"), ("\\x41bcde", "abcde"), ("(", None), ("a.cdefg", "cdefg"),
    ("(?:one|two) three", " three"), ("\\v1234", None), ("p(?i:QRST)uvwx", "uvwx"), ("", None), ("ab(?<!x)cd", "abcd"), ("(?<!no )longer", "longer"), ("q{2,}wert", "wert"), ("\\0101abcd", None), ("İstanbul", "İstanbul"),
]


@pytest.mark.parametrize("pattern,literal", PATTERNS)
def test_longest_required_literal(pattern, literal):
    assert max(rule_index.required_literals(pattern), key=len, default=None) == literal


def test_all_literals():
    assert rule_index.required_literals("Viewed (?:the|a) page '12'$") == ["viewed ", " page '12'"]


def test_every_match_holds_its_literal():
    rng = random.Random(1)
    parts = ["ab", "c", "[ab]", "(ab)", "(?:a|bc)", "a?", "b+", "(ca){2}", ".", "\\w", "(?=a)", "c*", "(b)?", "^", "$"]
    for _ in range(3000):
        pattern = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))
        literals = rule_index.required_literals(pattern)
        for _ in range(20):
            text = "".join(rng.choice("abc") for _ in range(rng.randrange(8)))
            assert not re.search(pattern, text) or all(x in text for x in literals), (pattern, text)


def test_five_thousand_rules_equal_brute_force(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnoprstuwz") for _ in range(rng.randrange(3, 8))) for _ in range(400)]
    make = lambda i: rng.choice(
        [f"{rng.choice(words)} {rng.choice(words)}", f"{rng.choice(words).upper()}\\s+(\\w+)", f"(?<id>{rng.choice(words)}) [a-z]+", f"'{i}'", f"^{rng.choice(words)}[^x]*{rng.choice(words)}$"]
    )
    table = [(i, rng.randrange(5), make(i)) for i in range(5000)] + [(6000, 3, "[xq]\\d"), (6001, 0, "a|b"), (6002, 1, None)]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(12))) + rng.choice(["", f" '{rng.randrange(5000)}'", " x1", " Ż😀"])) for i in range(250)] + [(900, None), (901, ""), (902, "long " * 40_000 + words[0])]
    t = spark.createDataFrame(texts, "id int, text string")
    r = spark.createDataFrame(table, "rule_no int, priority int, match_rx string")
    index = rule_index.rule_index(r)
    assert index.count() == 5002 and index.filter("piece is null").count() < 700
    for case in (False, True):
        got = rule_index.match_rules_indexed(t, r, "text", ["id"], case, index)
        want = rules.match_rules_joined(t, r.filter("match_rx is not null"), "text", ["id"], case)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    tried = rule_index.candidates(t, index.filter("piece is not null"), "text", ["id"]).count()
    assert tried < 252 * 5002 / 100  # regex tests in place of one for each text and rule
    plan = rule_index.candidates(t, index.filter("piece is not null"), "text", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and plan.count("HashJoin") + plan.count("SortMergeJoin") >= 2


def test_no_rules_and_no_texts(spark):
    t = spark.createDataFrame([(1, "some text")], "id int, text string")
    r = spark.createDataFrame([(1, 1, "some")], "rule_no int, priority int, match_rx string")
    assert rule_index.match_rules_indexed(t, r.filter("false"), "text", ["id"]).count() == 0
    assert rule_index.match_rules_indexed(t.filter("false"), r, "text", ["id"]).count() == 0
    assert rule_index.match_rules_indexed(t.withColumn("text", F.upper("text")), r, "text", ["id"], case_sensitive=True).count() == 0


def test_rules_are_never_broadcast_and_few_pieces_of_a_text_are_joined(spark):
    """Rules as many as their users: the driver gets a filter of fixed size, and a text meets few rules that it doesn't match."""
    table = [(i, 1, f"^the user with id '{i}' +(?:viewed|clicked) module") for i in range(10_000, 13_000)]
    index = rule_index.rule_index(spark.createDataFrame(table, "rule_no int, priority int, match_rx string"))
    texts = spark.range(300).select("id", F.format_string("The user with id '%d' viewed module id '%d'.", F.col("id") * 7 + 10_000, F.col("id")).alias("text"))
    found = rule_index.candidates(texts, index, "text", ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") >= 2
    assert rule_index._text_pieces(texts.withColumnRenamed("text", "_text"), index, ["id"]).count() < 300 * 5  # of more than 40 places each
    assert found.count() == 300
    assert rule_index.match_rules_indexed(texts, index, "text", ["id"], index=index).filter("rule_no = id * 7 + 10000").count() == 300


def test_filter_of_pieces(spark):
    pieces = [0, 1, 32767, 32768, 32769, 65536, 65537, rule_index.FILTER_BITS - 1, -1, -(1 << 63), 5 + 3 * rule_index.FILTER_BITS]
    held = np.unpackbits(rule_index._piece_filter(spark.createDataFrame([(p,) for p in pieces], "piece long")))
    assert np.flatnonzero(held).tolist() == sorted({p % rule_index.FILTER_BITS for p in pieces})
