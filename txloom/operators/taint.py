"""One- and two-hop exposure of UTXO addresses to labelled addresses.

Only the smallest amount and the largest score of an (address, label) pair within a transaction are
used downstream (the reference takes any value, here it is the smallest). Among the labelled
addresses of a transaction it is therefore enough to keep, per label, the few with the smallest
amounts and the few with the largest scores: each later step excludes at most one address, so the
best remaining one is always among them. This keeps the joins linear in the transaction size where
pairing all inputs with all labelled outputs would be quadratic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txloom.functions.columns import DROPPED_TYPES
from txloom.functions.relations import union_all
from txloom.operators.value_flow import with_day_price

UNITS_PER_COIN = 100_000_000
FULL_WEIGHT_USD = 10_000
Keep = Callable[[str, DataFrame], DataFrame]
RELATION_COLUMNS = ("address", "plots", "relation", "idx", "sub_weight")


def _lines(side: str, fields: tuple[str, ...]) -> Column:
    names = ("value", "type", "addresses", *fields)
    zipped = F.arrays_zip(*[F.col(f"{side}.{n}").alias(n) for n in names])
    return F.filter(zipped, lambda x: ~x["type"].isin(*DROPPED_TYPES))


def _total(lines: str) -> Column:
    """Sum of the line values, each counted once per address of the line."""
    return F.aggregate(
        lines, F.lit(0).cast("long"), lambda acc, x: acc + x["value"].cast("long") * F.size(x["addresses"])
    )


def _folded(
    tx: DataFrame, price: DataFrame, side: str, total: str, count: str, fields: tuple[str, ...] = ()
) -> DataFrame:
    """One row per transaction: price, total of the side and its lines as an array."""
    lines = tx.select("hash", "block_timestamp", count, _lines(side, fields).alias("lines"))
    return with_day_price(lines, price, "inner").select("hash", count, "price", _total("lines").alias(total), "lines")


def _unfold(folded: DataFrame, usd: str) -> DataFrame:
    """One row per line and address, other columns kept.

    Outer, as an inner unfolding first tests the size of the lines, for which it makes them a second time; rows
    without lines end at their addresses.
    """
    kept = [c for c in folded.columns if c not in ("lines", "price")]
    fields = [f for f in folded.schema["lines"].dataType.elementType.names if f not in ("addresses", "type", "value")]
    return folded.select(*kept, "price", F.inline_outer("lines")).select(
        *kept,
        F.explode("addresses").alias("address"),
        "value",
        (F.col("value") / UNITS_PER_COIN * F.col("price")).alias(usd),
        *fields,
    )


def _folded_inputs(tx: DataFrame, price: DataFrame, *fields: str) -> DataFrame:
    return _folded(tx, price, "inputs", "total_in", "input_count", fields)


def _folded_outputs(tx: DataFrame, price: DataFrame, *fields: str) -> DataFrame:
    return _folded(tx, price, "outputs", "total_out", "output_count", fields)


def input_ledger(tx: DataFrame, price: DataFrame, origins: bool = False) -> DataFrame:
    """One row per input line and address, with its USD value and the transaction's input total.

    `origins` adds the spent transaction and index, the widest columns of an input; a ledger
    without them does not read them.
    """
    fields = ("spent_transaction_hash", "spent_output_index") if origins else ()
    return _unfold(_folded_inputs(tx, price, *fields), "spent_usd_value")


def output_ledger(tx: DataFrame, price: DataFrame, positions: bool = False) -> DataFrame:
    """One row per output line and address, with its USD value and the transaction's output total."""
    return _unfold(_folded_outputs(tx, price, *(["index"] if positions else [])), "receive_usd_value")


def spent_totals(inputs: DataFrame) -> DataFrame:
    return inputs.groupBy("address").agg(
        F.sum("value").alias("total_output"), F.sum("spent_usd_value").alias("total_usd")
    )


def received_totals(outputs: DataFrame) -> DataFrame:
    return outputs.groupBy("address").agg(
        F.sum("value").alias("total_output"), F.sum("receive_usd_value").alias("total_usd")
    )


def labels_of(tags: DataFrame) -> DataFrame:
    """One score per (address, plots)."""
    return tags.where(F.col("plots").isNotNull()).groupBy("address", "plots").agg(F.max("score").alias("score"))


def _common(folded: DataFrame, labels: DataFrame, count: str, relation: str, idx: int) -> DataFrame:
    marked = (
        _unfold(folded.select("hash", "price", "lines"), "usd")
        .select("hash", "address")
        .join(labels, "address")
        .groupBy("hash", "plots")
        .agg(F.min("address").alias("ref_address"), F.max("score").alias("base_score"))
    )
    weight = F.when(F.col(count) <= 3, F.lit(1.0)).otherwise(F.lit(3) / F.col(count) * F.col("base_score"))
    return (
        folded.select("hash", count, F.flatten("lines.addresses").alias("addresses"))
        .join(marked, "hash")
        .select("plots", "ref_address", weight.alias("sub_weight"), F.explode_outer("addresses").alias("address"))
        .where(F.col("address") != F.col("ref_address"))
        .select("address", "plots", F.lit(relation).alias("relation"), F.lit(idx).alias("idx"), "sub_weight")
        .distinct()
    )


def _leading_refs(refs: DataFrame, keep: int) -> DataFrame:
    """Per (hash, plots), the `keep` addresses with the smallest amounts and with the largest scores.

    `refs` has one row per (hash, plots, ref_address). Each row stands in both rankings, which are groups of one
    window with a plain limit, so Spark keeps `keep` rows of a ranking while it reads it. Each ranking settles ties by
    the other's order, so with equal scores or amounts both keep the same rows.
    """
    amount, scored = F.col("ref_amount"), -F.col("base_score")
    order = [F.when(F.col("_ranking") == 0, amount), scored, amount, F.col("ref_address")]
    rank = F.row_number().over(Window.partitionBy("hash", "plots", "_ranking").orderBy(*order))
    both = refs.withColumn("_ranking", F.explode(F.array(F.lit(0), F.lit(1))))
    return both.withColumn("_rank", rank).where(F.col("_rank") <= keep).drop("_rank", "_ranking").distinct()


def _exposure_score(pairs: DataFrame, totals: DataFrame, relation: str, idx: int) -> DataFrame:
    """Weight per (address, plots) from rows (hash, address, plots, usd, base_score)."""
    usd = F.col("total")
    return (
        pairs.groupBy("hash", "address", "plots")
        .agg(F.min("usd").alias("usd"), F.max("base_score").alias("base_score"))
        .groupBy("address", "plots")
        .agg(F.sum("usd").alias("total"), F.max("base_score").alias("base_score"))
        .where(usd > 0)
        .join(totals.select("address", "total_usd"), "address", "left")
        .select(
            "address",
            "plots",
            F.lit(relation).alias("relation"),
            F.lit(idx).alias("idx"),
            (
                usd / F.col("total_usd") * F.col("base_score")
                * F.when(usd > FULL_WEIGHT_USD, F.lit(1.0)).otherwise(usd / FULL_WEIGHT_USD)
            ).alias("sub_weight"),
        )
    )


def _labelled(ledger: DataFrame, labels: DataFrame, *more: Column) -> DataFrame:
    """Labelled addresses per transaction, one row per (hash, plots, ref_address).

    One shuffle by hash serves this aggregation, the ranking after it and the join with the
    transaction's other side.
    """
    return (
        ledger.join(labels, "address")
        .withColumnRenamed("address", "ref_address")
        .repartition("hash")
        .groupBy("hash", "plots", "ref_address")
        .agg(F.min("value").alias("ref_amount"), F.max("score").alias("base_score"), *more)
    )


def _source_refs(outputs: DataFrame, labels: DataFrame) -> DataFrame:
    """The leading labelled receivers of each transaction."""
    return _leading_refs(_labelled(outputs.select("hash", "address", "value"), labels), 3)


def _of_positive(folded: DataFrame, total: str) -> DataFrame:
    """Only transactions with a positive total keep lines. A filter on the total would make the lines once more below it."""
    return folded.withColumn("lines", F.when(F.col(total) > 0, F.col("lines")))


def _source_pairs(folded_inputs: DataFrame, refs: DataFrame) -> DataFrame:
    """Input lines paired with the leading labelled receivers of their transaction."""
    share = F.col("ref_amount") / F.col("total_in")
    paired = _unfold(_of_positive(folded_inputs, "total_in").join(refs, "hash"), "spent_usd_value")
    return paired.where(F.col("address") != F.col("ref_address")).withColumn("usd", F.col("spent_usd_value") * share)


def _dest_refs(inputs: DataFrame, labels: DataFrame) -> DataFrame:
    """The leading labelled spenders of each transaction, with what it spent in all."""
    spenders = inputs.select("hash", "address", "value", "total_in")
    return _leading_refs(_labelled(spenders, labels, F.min("total_in").alias("ref_total")), 3)


def _dest_pairs(folded_outputs: DataFrame, refs: DataFrame) -> DataFrame:
    """Output lines paired with the leading labelled spenders of their transaction."""
    paired = _unfold(folded_outputs.join(refs, "hash"), "usd")
    return paired.where(F.col("address") != F.col("ref_address"))


def _refs_of_transaction(refs: DataFrame) -> DataFrame:
    """One row per transaction with its leading labelled addresses, a few for every label code."""
    fields = [c for c in refs.columns if c != "hash"]
    return refs.groupBy("hash").agg(F.collect_list(F.struct(*fields)).alias("refs"))


def _owned(*fields: tuple[str, str]) -> Column:
    """The lines that have an address, as `fields` and `owner`: the only address of a line, NULL if it has several."""
    owners = F.transform("lines", lambda x: F.struct(x.alias("line"), F.array_distinct(F.array_compact(x["addresses"])).alias("owners")))
    return F.transform(
        F.filter(owners, lambda x: F.size(x["owners"]) > 0),
        lambda x: F.struct(
            *[x["line"][name].alias(alias) for name, alias in fields],
            F.when(F.size(x["owners"]) == 1, x["owners"][0]).alias("owner"),
        ),
    )


def _reached(lines: str, total: Callable[[Column], Column]) -> Column:
    """The labelled addresses `refs` that a line of another owner leads to, each with the smallest amount of these lines."""
    with_lines = F.transform(
        "refs",
        lambda r: F.struct(
            r.alias("ref"), F.filter(lines, lambda x: x["owner"].isNull() | (x["owner"] != r["ref_address"])).alias("lines")
        ),
    )
    return F.transform(
        F.filter(with_lines, lambda r: F.size(r["lines"]) > 0),
        lambda r: F.struct(
            r["ref"]["plots"].alias("plots"),
            r["ref"]["ref_address"].alias("ref_address"),
            F.array_min(F.transform(r["lines"], lambda x: x["value"] * F.try_divide(r["ref"]["ref_amount"], total(r["ref"])))).alias("amount"),
            r["ref"]["base_score"].alias("base_score"),
        ),
    )


class Exposure:
    """What the six relations share: ledgers, totals per address and leading labels, each defined once.

    `keep(name, frame)` may store a shared part and return the stored one, so that it is computed once; by default
    every relation plans its parts anew. `chained` reads what links a transaction to the next, the widest columns
    of the ledgers, which the common and direct relations alone do not need.
    """

    def __init__(self, tx: DataFrame, price: DataFrame, labels: DataFrame, keep: Keep | None = None, chained: bool = True):
        self.labels, self._keep, self._parts = labels, keep or (lambda name, frame: frame), {}
        self._tx, self._price, self._chained = tx, price, chained

    def _part(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._parts:
            self._parts[name] = self._keep(name, build())
        return self._parts[name]

    @property
    def inputs(self) -> DataFrame:
        fields = ("spent_transaction_hash", "spent_output_index") if self._chained else ()
        return self._part("inputs", lambda: _folded_inputs(self._tx, self._price, *fields))

    @property
    def outputs(self) -> DataFrame:
        return self._part("outputs", lambda: _folded_outputs(self._tx, self._price, *(("index",) if self._chained else ())))

    @property
    def spent(self) -> DataFrame:
        return self._part("spent", lambda: spent_totals(_unfold(self.inputs, "spent_usd_value")))

    @property
    def received(self) -> DataFrame:
        return self._part("received", lambda: received_totals(_unfold(self.outputs, "receive_usd_value")))

    @property
    def source_refs(self) -> DataFrame:
        return self._part("source_refs", lambda: _source_refs(_unfold(self.outputs, "receive_usd_value"), self.labels))

    @property
    def dest_refs(self) -> DataFrame:
        return self._part("dest_refs", lambda: _dest_refs(_unfold(self.inputs, "spent_usd_value"), self.labels))

    def common_input(self) -> DataFrame:
        return _common(self.inputs, self.labels, "input_count", "common input", 1)

    def common_output(self) -> DataFrame:
        return _common(self.outputs, self.labels, "output_count", "common output", 2)

    def direct_source(self) -> DataFrame:
        return _exposure_score(_source_pairs(self.inputs, self.source_refs), self.spent, "direct source", 3)

    def direct_dest(self) -> DataFrame:
        return _exposure_score(_dest_pairs(self.outputs, self.dest_refs), self.received, "direct dest", 4)

    def indirect_source(self) -> DataFrame:
        # a transaction sends each one it spends from a row: the lines spent there and its own labelled receivers
        lines = _owned(("spent_transaction_hash", "origin"), ("spent_output_index", "index"), ("value", "value"))
        inputs = _of_positive(self.inputs, "total_in")
        sent = (
            inputs.select("hash", "total_in", F.inline_outer(lines))
            .groupBy("hash", "total_in", "origin")
            .agg(F.collect_list(F.struct("index", "value", "owner")).alias("spent"))
            .join(_refs_of_transaction(self.source_refs), "hash")
            .select(F.col("origin").alias("hash"), "total_in", "spent", "refs")
            .repartition("hash")  # serves the join and all that follows
        )
        # the spent output must be one that counts
        counted = F.transform(F.filter("lines", lambda x: F.size(x["addresses"]) > 0), lambda x: x["index"])
        refs = (
            sent.join(self.outputs.select("hash", counted.alias("counted")), "hash")
            .withColumn("spent", F.filter("spent", lambda x: F.array_contains("counted", x["index"])))
            .select("hash", F.inline_outer(_reached("spent", lambda ref: F.col("total_in"))))
            .where(F.col("ref_address").isNotNull())
            .groupBy("hash", "plots", "ref_address")
            .agg(F.min("amount").alias("ref_amount"), F.max("base_score").alias("base_score"))
        )
        pairs = (
            _unfold(inputs.join(_leading_refs(refs, 2), "hash"), "spent_usd_value")
            .where(F.col("address") != F.col("ref_address"))
            .withColumn("usd", F.col("spent_usd_value") * F.col("ref_amount") / F.col("total_in"))
        )
        return _exposure_score(pairs, self.spent, "indirect source", 5)

    def indirect_dest(self) -> DataFrame:
        # a line that has an address, once: its addresses are found by the next step
        owned = F.filter("lines", lambda x: F.size(x["addresses"]) > 0)
        spent = F.transform(
            owned, lambda x: F.struct(x["spent_transaction_hash"].alias("origin"), x["spent_output_index"].alias("index"))
        )
        spends = (
            self.inputs.select("hash", "total_in", F.inline_outer(F.array_distinct(spent)))
            .groupBy("hash", "total_in", "origin")
            .agg(F.collect_list("index").alias("spent"))
            .select(F.col("origin").alias("hash"), F.col("hash").alias("next_hash"), F.col("total_in").alias("next_total"), "spent")
            .repartition("hash")
            .select("hash", "next_hash", "next_total", F.explode("spent").alias("index"))
        )
        # amounts are settled where the outputs lie: the next transaction gets a row with the labels that reach it
        refs = (
            self.outputs.select("hash", F.inline_outer(_owned(("index", "index"), ("value", "value"))))
            .join(spends, ["hash", "index"])
            .groupBy("hash", "next_hash", "next_total")
            .agg(F.collect_list(F.struct("value", "owner")).alias("received"))
            .join(_refs_of_transaction(self.dest_refs), "hash")
            .select(F.col("next_hash").alias("hash"), "next_total", _reached("received", lambda ref: ref["ref_total"]).alias("refs"))
            .repartition("hash")
            .select("hash", "next_total", F.inline_outer("refs"))
            .where(F.col("ref_address").isNotNull())
            .groupBy("hash", "plots", "ref_address")
            .agg(
                F.min("amount").alias("ref_amount"),
                F.max("base_score").alias("base_score"),
                F.min("next_total").alias("next_total"),
            )
        )
        outputs = _of_positive(self.outputs, "total_out")
        pairs = (
            _unfold(outputs.join(_leading_refs(refs, 2), "hash"), "receive_usd_value")
            .where(F.col("address") != F.col("ref_address"))
            .withColumn("usd", F.try_divide(F.col("receive_usd_value") * F.col("ref_amount"), F.col("next_total")))
        )
        return _exposure_score(pairs, self.received, "indirect dest", 6)


def common_input(tx: DataFrame, price: DataFrame, labels: DataFrame) -> DataFrame:
    """Addresses that spend together with a labelled address (idx 1)."""
    return Exposure(tx, price, labels, chained=False).common_input()


def common_output(tx: DataFrame, price: DataFrame, labels: DataFrame) -> DataFrame:
    """Addresses that receive together with a labelled address (idx 2)."""
    return Exposure(tx, price, labels, chained=False).common_output()


def direct_source(tx: DataFrame, price: DataFrame, labels: DataFrame) -> DataFrame:
    """Addresses whose money went to a labelled address (idx 3)."""
    return Exposure(tx, price, labels, chained=False).direct_source()


def direct_dest(tx: DataFrame, price: DataFrame, labels: DataFrame) -> DataFrame:
    """Addresses that received money from a labelled address (idx 4)."""
    return Exposure(tx, price, labels, chained=False).direct_dest()


def indirect_source(tx: DataFrame, price: DataFrame, labels: DataFrame) -> DataFrame:
    """Addresses whose money went to a labelled address through one transaction between (idx 5)."""
    return Exposure(tx, price, labels).indirect_source()


def indirect_dest(tx: DataFrame, price: DataFrame, labels: DataFrame) -> DataFrame:
    """Addresses that received a labelled address's money through one transaction between (idx 6)."""
    return Exposure(tx, price, labels).indirect_dest()


def direct_labels(curated: DataFrame) -> DataFrame:
    """The curated labels themselves (idx 0)."""
    return curated.select(
        "address", "plots", F.lit("direct").alias("relation"), F.lit(0).alias("idx"), F.lit(1.0).alias("sub_weight")
    ).distinct()


def taint_propagation(
    tx: DataFrame, price: DataFrame, tags: DataFrame, curated: DataFrame, keep: Keep | None = None
) -> DataFrame:
    """All seven relations. `tags` is the seed view with scores, `curated` the hand-made labels alone.

    `keep` stores what relations share (see `Exposure`).
    """
    e = Exposure(tx, price, labels_of(tags), keep)
    spread = [e.common_input, e.common_output, e.direct_source, e.direct_dest, e.indirect_source, e.indirect_dest]
    relations = [direct_labels(curated), *[relation() for relation in spread]]
    return union_all([r.select(*RELATION_COLUMNS) for r in relations])


def account_exposure(transfers: DataFrame, curated: DataFrame) -> DataFrame:
    """Share of an account's spending (idx 3) and receipts (idx 4) that involved a labelled address.

    `transfers` are successful transfers (from_address, to_address, usd_value). The total in the
    ratio is damped by a million USD.

    One pass serves both directions: each transfer is a line of its receiver and a line of its sender. A line counts
    once without a label, for the total, and once for every label of the other end. Sums per (address, idx, label)
    combine before the shuffle, and only these sums meet their total.
    """
    labels = curated.where(F.col("plots").isNotNull()).groupBy("address").agg(F.collect_set("plots").alias("plots"))
    ends = F.array(
        F.struct(F.col("to_address").alias("owner"), F.col("from_address").alias("address"), F.lit(4).alias("idx")),
        F.struct(F.col("from_address").alias("owner"), F.col("to_address").alias("address"), F.lit(3).alias("idx")),
    )
    none = F.array(F.lit(None).cast("string"))
    lines = transfers.select("usd_value", F.inline(ends)).join(labels, "address", "left")
    sums = (
        lines.where(F.col("owner").isNotNull())
        .select("owner", "idx", "usd_value", F.explode(F.concat(none, F.coalesce("plots", F.array().cast("array<string>")))).alias("plots"))
        .groupBy("owner", "idx", "plots")
        .agg(F.sum("usd_value").alias("usd"))
    )
    shares = sums.groupBy("owner", "idx").agg(
        F.sum(F.when(F.col("plots").isNull(), F.col("usd"))).alias("total"),
        F.collect_list(F.when(F.col("plots").isNotNull(), F.struct("plots", "usd"))).alias("labelled"),
    )
    weight = F.col("usd") / (F.col("total") + 1e6)
    return shares.select("owner", "idx", "total", F.inline("labelled")).select(
        F.col("owner").alias("address"), "plots", "idx", weight.alias("sub_weight")
    )
