"""Tag tables brought together: categories over protocols, seed labels, one tag view per chain."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txloom.functions.relations import TAG_COLUMNS, tag_rows, union_all, union_distinct


@dataclass(frozen=True)
class CategorySpec:
    feature: str
    idx: int
    sources: tuple[str, ...]  # names of protocol user tables
    plots: str = "P701"


# Fixed values. The flash-loan category carries the depositors' label and idx, idx 4 stays unused.
CATEGORIES: dict[str, CategorySpec] = {
    "dex_trader": CategorySpec("Dex trader", 0, ("uniswap_trader", "balancer_trader", "curve_trader")),
    "dex_liquidity_provider": CategorySpec("Dex liquitity provider", 1, ("balancer_investor",)),
    "decentralised_loaner": CategorySpec(
        "Decentralised loaner", 2, ("aave_borrower", "compound_borrower", "dydx_user")
    ),
    "decentralised_loan_depositor": CategorySpec(
        "Decentralised loan depositor", 3, ("aave_depositor", "compound_supplier")
    ),
    "decentralised_flashloan_user": CategorySpec(
        "Decentralised loan depositor", 3, ("aave_flashloan_user", "balancer_flashloan_user")
    ),
    "decentralised_options_user": CategorySpec("Decentralised options user", 5, ("opyn_user",)),
    "decentralised_funds_user": CategorySpec("Decentralised funds user", 6, ("yearn_user",)),
}


def category_tags(spec: CategorySpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct addresses of the category's tables, tagged."""
    addresses = union_distinct(*[tables[name].select("address") for name in spec.sources])
    return tag_rows(addresses, spec.feature, spec.plots, spec.idx)


def categories_of(users: DataFrame) -> DataFrame:
    """The tags of all categories from one table of protocol users (table, address), read once."""
    by_source: dict[str, list[CategorySpec]] = {}
    for spec in CATEGORIES.values():
        for source in spec.sources:
            by_source.setdefault(source, []).append(spec)
    tags = F.create_map(
        *[
            part
            for source, specs in by_source.items()
            for part in (
                F.lit(source),
                F.array(*[F.struct(F.lit(s.feature).alias("feature"), F.lit(s.plots).alias("plots"), F.lit(s.idx).alias("idx")) for s in specs]),
            )
        ]
    )
    tagged = users.select("address", F.inline(F.try_element_at(tags, F.col("table"))))
    return tag_rows(tagged, F.col("feature"), F.col("plots"), F.col("idx"))


def others_tags(deployers: DataFrame, eth2_depositors: DataFrame, nft: DataFrame) -> DataFrame:
    """Category P801: contract deployers, stakers, and the stored rows of non-fungible token users."""
    return union_distinct(
        tag_rows(deployers, "Contract deployer", "P801", 0),
        tag_rows(eth2_depositors, "ETH2.0 staker", "P801", 1),
        nft.select(*TAG_COLUMNS),
    )


def utxo_seed_tags(curated: DataFrame, coinjoin: DataFrame) -> DataFrame:
    """Curated labels (score 1) and mixers with their score, the input of taint propagation."""
    columns = ["address", "feature", "name", "plots", "score"]
    return union_distinct(
        curated.select("address", "feature", "name", "plots", F.lit(1.0).alias("score")),
        coinjoin.withColumn("name", F.lit(None).cast("string")).select(*columns),
    )


def _recoded(codes: Mapping[int, int]) -> Column:
    """`idx` under new numbers, NULL where it has none."""
    (first, value), *rest = codes.items()
    out = F.when(F.col("idx") == first, F.lit(value))
    for old, new in rest:
        out = out.when(F.col("idx") == old, F.lit(new))
    return out


def _behaviour_tags(
    fast_tx: DataFrame,
    high_fee: DataFrame,
    high_fee_codes: Mapping[int, int],
    inactive: DataFrame,
    periodic: DataFrame,
    keep_name: bool,
) -> list[DataFrame]:
    feature = F.col("feature")
    return [
        tag_rows(fast_tx, feature, "P112", _recoded({1: 11, 2: 12, 3: 13}), F.col("name") if keep_name else None),
        tag_rows(high_fee, feature, "P121", _recoded(high_fee_codes)),
        tag_rows(inactive, "inactive", "P117", 4),
        tag_rows(periodic, "periodic inactive", "P118", 5),
    ]


def utxo_union_tags(
    fast_tx: DataFrame,
    high_fee: DataFrame,
    large_value: DataFrame,
    mimo: DataFrame,
    inactive: DataFrame,
    periodic: DataFrame,
) -> DataFrame:
    """Behaviour tags of the UTXO chain under common codes."""
    plots = F.when(F.col("plots") == "401", F.lit("P401")).otherwise(F.col("plots"))
    return union_all(
        [
            *_behaviour_tags(fast_tx, high_fee, {1: 10, 2: 11}, inactive, periodic, keep_name=True),
            tag_rows(large_value, F.col("feature"), plots, F.col("idx")),
            tag_rows(mimo, F.col("feature"), F.col("plots"), 1, F.col("name")),
        ]
    ).distinct()


def account_union_tags(
    fast_tx: DataFrame,
    high_fee: DataFrame,
    large_value: DataFrame,
    inactive: DataFrame,
    periodic: DataFrame,
    others: DataFrame,
    categories: Mapping[str, DataFrame] | DataFrame,
) -> DataFrame:
    """Behaviour, P801 and category tags of the account chain under common codes.

    `categories` are the category tables by name, or the rows of all of them (`categories_of`).
    """
    by_category = [categories] if isinstance(categories, DataFrame) else [categories[name] for name in CATEGORIES]
    return union_all(
        [
            *_behaviour_tags(fast_tx, high_fee, {11: 10, 10: 11}, inactive, periodic, keep_name=False),
            tag_rows(large_value, F.col("feature"), F.col("plots"), F.col("idx")),
            others.select(*TAG_COLUMNS),
            *[tags.select(*TAG_COLUMNS) for tags in by_category],
        ]
    ).distinct()
