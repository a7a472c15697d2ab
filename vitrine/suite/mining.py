"""Registered queries for association rules, on order baskets and on shops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import np_round
from ..operators import rules
from ..plans import arguments as args
from ..plans import dashboard, tools
from ..sources.listings import table
from . import data
from .oracle_base import with_ctes

QUERIES = {}
ORACLES = {}


def _lines(spark, sf) -> DataFrame:
    """Order lines with their part type: the basket is the order."""
    return table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_type")


def _itemsets(spark, sf) -> DataFrame:
    return rules.frequent_itemsets(rules.build_baskets(_lines(spark, sf), "l_orderkey", "p_type"), min_support=0.1)


def _rules(spark, sf) -> DataFrame:
    return data.shared(spark, sf, "rules", lambda: rules.generate_rules(_itemsets(spark, sf)))


_MEASURES = [
    "antecedent_support", "consequent_support", "support", "confidence", "lift", "leverage", "conviction", "zhangs_metric",
]


def _texts(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.array_join(c, ", ") for c in ("antecedents", "consequents")})


EXTRA = {
    "types": ("SELECT list(DISTINCT p_type ORDER BY p_type) AS names FROM part", []),
    "basket_masks": (
        """SELECT l_orderkey, CAST(bit_or(1 << (list_position(names, p_type) - 1)) AS BIGINT) AS m, count(DISTINCT p_type) AS k
FROM lineitem JOIN part ON p_partkey = l_partkey, types GROUP BY 1""",
        ["types"],
    ),
    "kept": ("SELECT m FROM basket_masks WHERE k >= 2", ["basket_masks"]),
    "masks": ("SELECT m FROM range(1, 1 << (SELECT len(names) FROM types)) r(m)", ["types"]),
    "frequent": (
        """SELECT * FROM (SELECT masks.m, count(*) AS freq, (SELECT count(*) FROM kept) AS n FROM masks JOIN kept ON kept.m & masks.m = masks.m
GROUP BY 1) WHERE freq >= 0.1 * n""",
        ["masks", "kept"],
    ),
    "named": (
        """SELECT m, freq, n, freq / CAST(n AS DOUBLE) AS support,
list_filter(names, lambda x, i: (m >> (i - 1)) & 1 = 1) AS items FROM frequent, types""",
        ["frequent"],
    ),
    "measured": (
        """SELECT array_to_string(a.items, ', ') AS antecedents, array_to_string(c.items, ', ') AS consequents, a.support AS antecedent_support,
c.support AS consequent_support, i.support, i.support / a.support AS confidence, i.support / a.support / c.support AS lift,
i.support - a.support * c.support AS leverage,
CASE WHEN i.support / a.support >= 1 THEN 'inf'::DOUBLE ELSE (1 - c.support) / (1 - i.support / a.support) END AS conviction,
(i.support - a.support * c.support) / greatest(i.support * (1 - a.support), a.support * (c.support - i.support)) AS zhangs_metric
FROM named i JOIN named a ON a.m & i.m = a.m AND a.m <> i.m JOIN named c ON c.m = i.m - a.m""",
        ["named"],
    ),
}


def _sql(query: str, wanted="measured") -> str:
    return with_ctes(wanted, query, EXTRA)


def _r(c: str, digits: int = 6) -> str:
    return f"round_even({c} * 1e{digits}, 0) / 1e{digits} AS {c}"


QUERIES["order_baskets"] = lambda spark, sf: rules.build_baskets(_lines(spark, sf), "l_orderkey", "p_type").select(
    "basket_id", F.array_join("items", ", ").alias("items")
)
ORACLES["order_baskets"] = """SELECT l_orderkey AS basket_id, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS items
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1 HAVING count(DISTINCT p_type) >= 2"""

QUERIES["shop_baskets"] = lambda spark, sf: rules.build_baskets(data.silver(spark, sf)).select(
    "basket_id", F.array_join("items", ", ").alias("items")
)
ORACLES["shop_baskets"] = with_ctes(
    "silver",
    """SELECT shop_name AS basket_id, string_agg(DISTINCT category, ', ' ORDER BY category) AS items FROM silver GROUP BY 1
HAVING count(DISTINCT category) >= 2""",
)

QUERIES["frequent_itemsets"] = lambda spark, sf: _itemsets(spark, sf).select(
    F.array_join("items", ", ").alias("items"), "freq", "n_baskets", np_round(F.col("support"), 6).alias("support")
)
ORACLES["frequent_itemsets"] = _sql(f"SELECT array_to_string(items, ', ') AS items, freq, n AS n_baskets, {_r('support')} FROM named", "named")

QUERIES["generate_rules"] = lambda spark, sf: data.rounded(_texts(_rules(spark, sf)), _MEASURES)
ORACLES["generate_rules"] = _sql(f"SELECT antecedents, consequents, {', '.join(_r(c) for c in _MEASURES)} FROM measured")

QUERIES["filter_rules_confidence"] = lambda spark, sf: data.rounded(
    _texts(rules.filter_rules(_rules(spark, sf), "confidence", 0.2)).select("antecedents", "consequents", "confidence", "lift"), ["confidence", "lift"]
)
ORACLES["filter_rules_confidence"] = _sql(
    f"SELECT antecedents, consequents, {_r('confidence')}, {_r('lift')} FROM measured WHERE confidence >= 0.2"
)
QUERIES["filter_rules_lift"] = lambda spark, sf: data.rounded(
    _texts(rules.filter_rules(_rules(spark, sf), "lift", 0.95, 100)).select("antecedents", "consequents", "confidence", "lift"), ["confidence", "lift"]
)
ORACLES["filter_rules_lift"] = _sql(
    f"""SELECT antecedents, consequents, {_r('confidence')}, {_r('lift')} FROM (SELECT * FROM measured WHERE round(lift, 12) >= 0.95
ORDER BY lift DESC, confidence DESC, antecedents, consequents LIMIT 100)"""
)

QUERIES["mine_rules_shops"] = lambda spark, sf: data.rounded(
    _texts(rules.mine_rules(data.silver(spark, sf), "main")).select("antecedents", "consequents", "support", "confidence", "lift"),
    ["support", "confidence", "lift"],
)
ORACLES["mine_rules_shops"] = with_ctes(
    "its",
    """SELECT array_to_string(a.items, ', ') AS antecedents, array_to_string(c.items, ', ') AS consequents,
round_even(i.s * 1e6, 0) / 1e6 AS support, round_even(i.s / a.s * 1e6, 0) / 1e6 AS confidence, round_even(i.s / a.s / c.s * 1e6, 0) / 1e6 AS lift
FROM its i JOIN its a ON a.m & i.m = a.m AND a.m <> i.m JOIN its c ON c.m = i.m - a.m WHERE i.s / a.s >= 0.5""",
    {
        "cats": ("SELECT list(DISTINCT category ORDER BY category) AS names FROM silver", ["silver"]),
        "shop_masks": (
            "SELECT shop_name, CAST(bit_or(1 << (list_position(names, category) - 1)) AS BIGINT) AS m FROM silver, cats GROUP BY 1 HAVING count(DISTINCT category) >= 2",
            ["cats"],
        ),
        "its": (
            """SELECT m, s, list_filter(names, lambda x, i: (m >> (i - 1)) & 1 = 1) AS items FROM (SELECT r.m,
count(*) / CAST((SELECT count(*) FROM shop_masks) AS DOUBLE) AS s FROM range(1, 1 << (SELECT len(names) FROM cats)) r(m)
JOIN shop_masks b ON b.m & r.m = r.m GROUP BY 1), cats WHERE bit_count(m) <= 3 AND s >= greatest(0.3, 2e0 / (SELECT count(*) FROM shop_masks))""",
            ["shop_masks"],
        ),
    },
)

QUERIES["association_rules"] = lambda spark, sf: tools.association_rules(
    _rules(spark, sf).withColumns({c: np_round(F.col(c), 9) for c in ("lift", "confidence", "support")}), args.AssociationRules(min_lift=0.9, limit=10)
)
ORACLES["association_rules"] = _sql(
    f"""SELECT antecedents, consequents, {_r('support', 4)}, {_r('confidence', 4)}, {_r('lift', 4)} FROM (SELECT antecedents, consequents,
{_r('support', 9)}, {_r('confidence', 9)}, {_r('lift', 9)} FROM measured) WHERE lift >= 0.9
ORDER BY lift DESC, confidence DESC, antecedents, consequents LIMIT 10"""
)

QUERIES["rules_overview"] = lambda spark, sf: dashboard.rules_overview(_rules(spark, sf))
ORACLES["rules_overview"] = _sql(
    """SELECT count(*) AS n_rules, round_even(max(lift) * 1e4, 0) / 1e4 AS max_lift, round_even(avg(confidence) * 1e4, 0) / 1e4 AS avg_confidence
FROM measured"""
)

QUERIES["top_rules_by_lift"] = lambda spark, sf: dashboard.top_rules(
    _texts(_rules(spark, sf)).withColumns({c: np_round(F.col(c), 9) for c in ("support", "confidence", "lift")})
)
ORACLES["top_rules_by_lift"] = _sql(
    f"""SELECT * FROM (SELECT antecedents, consequents, {_r('support', 9)}, {_r('confidence', 9)}, {_r('lift', 9)} FROM measured)
ORDER BY lift DESC, confidence DESC, antecedents, consequents LIMIT 30"""
)
