"""Candidate pairs by blocking: equal rule columns, null never matches."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.settings import LinkSettings

# Rows of one block that meet in one join group; larger blocks are laid out as tiles of this size.
TILE_ROWS = 2048
# Blocks above TILE_ROWS are listed for the join; up to this many the list is broadcast, beyond it is shuffled.
BROADCAST_BLOCKS = 20_000
# Pairs one task should form; adaptive execution sees only the small join input, not the pairs it turns into.
PAIRS_PER_TASK = 500_000
ROWS_PER_TASK = 1_000_000
# New records of one batch that may be broadcast (their count is known to the caller).
BROADCAST_NEW = 100_000


class PairLimitExceeded(RuntimeError):
    """More candidate or matched pairs than the caller allows."""


def _known(rule: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule])


def with_block_keys(df: DataFrame, rules: tuple[tuple[str, ...], ...]) -> DataFrame:
    """One row per record and applicable rule: adds ``rule`` (1-based) and ``block`` (hash of the rule columns).

    All rules then share one join: a single scan and a single 12-byte key instead of a join per rule.
    """
    entries = [
        F.when(_known(rule), F.struct(F.lit(number).alias("rule"), F.xxhash64(*rule).alias("block")))
        for number, rule in enumerate(rules, 1)
    ]
    return df.select("*", F.inline(F.array_compact(F.array(*entries))))


def block_sizes(df: DataFrame, rules: tuple[tuple[str, ...], ...], weight: Column | None = None) -> DataFrame:
    """Rows per block as ``n``; only the rule columns are read, and tasks count before they shuffle."""
    columns = sorted({c for rule in rules for c in rule})
    source = df.select(*columns, (F.lit(1) if weight is None else weight).cast("long").alias("w"))
    return with_block_keys(source, rules).groupBy("rule", "block").agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("rows"))


def estimate_pairs(df: DataFrame, rules: tuple[tuple[str, ...], ...]) -> DataFrame:
    """Pairs each rule would produce, from block sizes alone: ``rule, blocks, largest_block, pairs``."""
    n = F.col("n").cast("decimal(38,0)")
    return (
        block_sizes(df, rules)
        .groupBy("rule")
        .agg(
            F.count(F.lit(1)).alias("blocks"),
            F.max("n").alias("largest_block"),
            F.sum(n * (n - 1) / 2).cast("decimal(38,0)").alias("pairs"),
        )
    )


def guard_max_pairs(pairs: int, limit: int) -> None:
    """Stop before anything is written when there are more than ``limit`` pairs."""
    if pairs > limit:
        raise PairLimitExceeded(f"{pairs:,} pairs exceed the limit of {limit:,}: use smaller batches or tighter rules")


@dataclass(frozen=True)
class BlockStats:
    """What the driver needs to lay out a blocking join."""

    pairs: int
    largest: int
    oversized: int
    rows: int = 0

    @property
    def tasks(self) -> int:
        """Join tasks that neither the rows nor the pairs overload."""
        return max(-(-self.pairs // PAIRS_PER_TASK), -(-self.rows // ROWS_PER_TASK))


def block_stats(df: DataFrame, rules: tuple[tuple[str, ...], ...], tile_rows: int = TILE_ROWS) -> BlockStats:
    """One small job over the rule columns. ``pairs`` counts a pair once per rule that finds it."""
    rows = F.col("rows").cast("decimal(38,0)")
    found = (
        block_sizes(df, rules)
        .agg(
            F.coalesce(F.sum(rows * (rows - 1) / 2), F.lit(0)).cast("decimal(38,0)").alias("pairs"),
            F.coalesce(F.max("rows"), F.lit(0)).alias("largest"),
            F.count_if(F.col("rows") > tile_rows).alias("oversized"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        )
        .first()
    )
    return BlockStats(int(found.pairs), int(found.largest), int(found.oversized), int(found.rows))


def _oversized(df: DataFrame, rules, tile_rows: int, stats: BlockStats) -> DataFrame:
    """Tiles per side of each oversized block."""
    tiles = F.ceil(F.col("rows") / tile_rows).cast("int")
    found = block_sizes(df, rules).filter(F.col("rows") > tile_rows).select("rule", "block", tiles.alias("tiles"))
    return F.broadcast(found) if stats.oversized <= BROADCAST_BLOCKS else found


def _tile(ident: str, tiles: Column) -> Column:
    return F.pmod(F.xxhash64(F.col(ident), F.lit(7)), tiles).cast("int")


def _holds(rule: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"l.{c}") == F.col(f"r.{c}") for c in rule])


def _first_found(rules: tuple[tuple[str, ...], ...]) -> Column:
    """The rule of the joined rows holds and no earlier one does (nulls never hold).

    As one conditional it concerns both sides only together. Nothing of it is pushed into one of them, so the sides
    of a self join stay alike and share a single shuffle.
    """
    found = F.when(F.lit(False), F.lit(False))
    for number, rule in enumerate(rules, 1):
        earlier = [~F.coalesce(_holds(r), F.lit(False)) for r in rules[: number - 1]]
        found = found.when(F.col("l.rule") == number, reduce(lambda a, b: a & b, earlier, _holds(rule)))
    return found


def _spread(keyed: DataFrame, tasks: int, keys: list[str]) -> DataFrame:
    """Fix the number of join tasks where there are pairs enough for several."""
    return keyed if tasks < 2 else keyed.repartition(max(tasks, keyed.sparkSession.sparkContext.defaultParallelism), *keys)


def _meet(left: DataFrame, right: DataFrame, keys: list[str], rules, extra: Column) -> DataFrame:
    same = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    # The hash is only the join key: the rule columns themselves are compared again here.
    return left.alias("l").join(right.alias("r"), reduce(lambda a, b: a & b, [*same, _first_found(rules), extra]))


def _sides(columns: list[str], swapped: Column | None = None) -> list[Column]:
    """``x_l`` and ``x_r`` for each column, with the sides exchanged where ``swapped``."""
    out = []
    for c in columns:
        left, right = F.col(f"l.{c}"), F.col(f"r.{c}")
        if swapped is None:
            out += [left.alias(f"{c}_l"), right.alias(f"{c}_r")]
        else:
            out += [F.when(swapped, right).otherwise(left).alias(f"{c}_l"), F.when(swapped, left).otherwise(right).alias(f"{c}_r")]
    return out


def _needed(df: DataFrame, settings: LinkSettings, carry: list[str] | None) -> tuple[DataFrame, list[str]]:
    shown = [settings.id_column, *(settings.columns if carry is None else carry)]
    inside = list(dict.fromkeys([*shown, *[c for rule in settings.rules for c in rule]]))
    return df.select(*inside), shown


def self_pairs(
    df: DataFrame,
    settings: LinkSettings,
    carry: list[str] | None = None,
    stats: BlockStats | None = None,
    max_pairs: int | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Unordered pairs of ``df``, each once under the first rule that finds it: ``x_l``, ``x_r``, ``rule``.

    ``id_l < id_r``. Columns are the id and ``carry`` (default: the compared columns). A block of more than
    ``tile_rows`` rows is laid out as a triangle of tiles, so that no join group holds more than two tiles and
    its pairs spread over the cluster; every pair of rows meets in exactly one tile.
    """
    rules, ident = settings.rules, settings.id_column
    stats = stats or block_stats(df, rules, tile_rows)
    if max_pairs is not None:
        guard_max_pairs(stats.pairs, max_pairs)
    rows, shown = _needed(df, settings, carry)
    keyed = with_block_keys(rows, rules)
    tasks = stats.tasks
    ordered = F.col(f"l.{ident}") < F.col(f"r.{ident}")
    if not stats.oversized:
        keyed = _spread(keyed, tasks, ["rule", "block"])
        return _meet(keyed, keyed, ["rule", "block"], rules, ordered).select(*_sides(shown), F.col("l.rule").alias("rule"))

    sized = keyed.join(_oversized(df, rules, tile_rows, stats), ["rule", "block"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = _tile(ident, F.col("tiles"))
    left = sized.withColumn("row_tile", own).withColumn("col_tile", F.explode(F.sequence("row_tile", F.col("tiles") - 1)))
    right = sized.withColumn("col_tile", own).withColumn("row_tile", F.explode(F.sequence(F.lit(0), "col_tile")))
    # On the diagonal a pair would meet twice; off it, the sides meet once in whichever order the tiles have.
    once = (F.col("l.row_tile") < F.col("l.col_tile")) | ordered
    keys = ["rule", "block", "row_tile", "col_tile"]
    met = _meet(_spread(left, tasks, keys), _spread(right, tasks, keys), keys, rules, once)
    return met.select(*_sides(shown, F.col(f"l.{ident}") > F.col(f"r.{ident}")), F.col("l.rule").alias("rule"))


def new_vs_all(
    new: DataFrame,
    everything: DataFrame,
    settings: LinkSettings,
    carry: list[str] | None = None,
    new_rows: int | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Pairs of a new record (side l) with any record of ``everything`` (side r), self pairs left out.

    ``everything`` contains the new records too, so a pair of new records comes in both orientations.
    """
    rows, shown = _needed(new, settings, carry)
    others, _ = _needed(everything, settings, carry)
    left, right = with_block_keys(rows, settings.rules), with_block_keys(others, settings.rules)
    distinct = F.col(f"l.{settings.id_column}") != F.col(f"r.{settings.id_column}")
    return keyed_new_vs_all(left, right, settings, shown, shown, distinct, new_rows, tile_rows)


def keyed_new_vs_all(
    left: DataFrame,
    right: DataFrame,
    settings: LinkSettings,
    left_columns: list[str],
    right_columns: list[str],
    condition: Column,
    new_rows: int | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """The join behind :func:`new_vs_all`, for sides that already carry ``rule`` and ``block``.

    With ``new_rows`` known and at most BROADCAST_NEW, the new side is broadcast and the other side is joined
    where it lies, so a hot block stays spread over the tasks that hold it. Otherwise both sides are shuffled;
    a block that is oversized on either side is laid out as a grid of tiles.
    """
    rules = settings.rules
    found = [
        *[F.col(f"l.{c}").alias(f"{c}_l") for c in left_columns],
        *[F.col(f"r.{c}").alias(f"{c}_r") for c in right_columns],
        F.col("l.rule").alias("rule"),
    ]
    if new_rows is not None and new_rows <= BROADCAST_NEW:
        return _meet(F.broadcast(left), right, ["rule", "block"], rules, condition).select(*found)
    sizes = [side.groupBy("rule", "block").agg(F.count(F.lit(1)).alias(n)) for side, n in ((left, "left_rows"), (right, "right_rows"))]
    sizes = sizes[0].join(sizes[1], ["rule", "block"]).filter((F.col("left_rows") > tile_rows) | (F.col("right_rows") > tile_rows))
    oversized = sizes.count()
    if not oversized:
        return _meet(left, right, ["rule", "block"], rules, condition).select(*found)
    tiles = [F.ceil(F.col(f"{side}_rows") / tile_rows).cast("int").alias(f"{side}_tiles") for side in ("left", "right")]
    sizes = sizes.select("rule", "block", *tiles)
    sizes = F.broadcast(sizes) if oversized <= BROADCAST_BLOCKS else sizes
    own, other = (F.coalesce(f"{side}_tiles", F.lit(1)) for side in ("left", "right"))
    # A grid of tiles: a row has one tile of its own side and goes to every tile of the other.
    left = left.join(sizes, ["rule", "block"], "left").withColumns({"left_tile": _tile(settings.id_column, own), "right_tile": F.explode(F.sequence(F.lit(0), other - 1))})
    right = right.join(sizes, ["rule", "block"], "left").withColumns({"right_tile": _tile(settings.id_column, other), "left_tile": F.explode(F.sequence(F.lit(0), own - 1))})
    return _meet(left, right, ["rule", "block", "left_tile", "right_tile"], rules, condition).select(*found)


def rule_pairs(df: DataFrame, settings: LinkSettings, number: int) -> DataFrame:
    """All pairs of one rule on its own, other rules set aside."""
    only = LinkSettings(settings.id_column, (settings.rules[number - 1],), settings.comparisons)
    return self_pairs(df, only, carry=[]).drop("rule")


def profile_pairs(
    profiles: DataFrame,
    settings: LinkSettings,
    carry: list[str],
    stats: BlockStats | None = None,
    max_pairs: int | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Pairs of collapsed records: both sides of the compared columns and of ``carry``, and ``pairs``.

    ``pairs`` is the number of record pairs a row stands for. The pairs among the copies of one profile are one
    row with the profile on both sides, provided a rule's columns are all present.
    """
    ident, columns = settings.id_column, settings.columns
    between = self_pairs(profiles, settings, [*columns, *carry, "copies"], stats, max_pairs, tile_rows)
    blocked = reduce(lambda a, b: a | b, [_known(rule) for rule in settings.rules])
    within = profiles.filter((F.col("copies") > 1) & blocked)
    n = F.col("copies")
    shown = [ident, *columns, *carry]
    within = within.select(*[F.col(c).alias(f"{c}_{side}") for c in shown for side in "lr"], (n * (n - 1) / 2).cast("long").alias("pairs"))
    between = between.withColumn("pairs", F.col("copies_l") * F.col("copies_r"))
    return between.select(*within.columns).union(within)


def rule_block_pairs(profiles: DataFrame, settings: LinkSettings, rule: tuple[str, ...], carry: list[str]) -> DataFrame:
    """:func:`profile_pairs` of a single rule."""
    return profile_pairs(profiles, LinkSettings(settings.id_column, (rule,), settings.comparisons), carry)
