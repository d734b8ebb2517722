"""Mixing sources to target weights by hierarchical budgets.

The corpus is a tree: domain, language, source (a leaf).  A token budget goes
down it.  At each node the children share the node's budget in proportion to
their weights, but none gets more than it can supply (its tokens times
``max_epochs``); what a child cannot take goes to its siblings, again by
weight, until all is placed or all are full.  As a node's own budget never
exceeds what its subtree can supply, a shortage is made up by siblings first
and reaches another branch only when the whole subtree is short.

The level that siblings are filled to is found in closed form: sorted by
supply per weight, the children before the level are full and the others get
``level * weight``.  Budgets are whole tokens (rounded down).

A leaf's budget buys whole epochs and a prefix of one more.  The order of a
leaf's documents in an epoch is a hash of (seed, epoch, id); a document is taken
while the running token count stays within the budget.  The running count is
kept per hash bucket (about ``bucket_rows`` documents, so their number grows
with the leaf); rows are numbered only inside the one bucket in which the prefix
ends.

Defined cases: NULL domain, language or source count as a value of their own; a
NULL text has no tokens and is taken with every epoch that reaches it; equal
rows are taken or left alike up to the prefix end; unknown names have weight
``default_weight``; weights of 0 give no budget; an empty table gives an empty
result; other columns are passed through by ``mix``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD_PATTERN, materialise

LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class MixConfig:
    """Targets: weights by name per level; names that are not listed have ``default_weight``."""

    budget_share: float = 0.9          # of the corpus' tokens
    budget_tokens: int | None = None   # overrides the share
    max_epochs: int = 2
    domain_weights: dict = field(default_factory=lambda: {"web": 5.0, "reference": 3.0, "forum": 2.0})
    lang_weights: dict = field(default_factory=lambda: {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0})
    source_weights: dict = field(default_factory=dict)
    default_weight: float = 1.0
    seed: str = "mix"
    bucket_rows: int = 2000


def domain_of(source: Column) -> Column:
    """Domain of a source name: by the remainder of its number by 3 (web,
    reference, forum); names without a number are web."""
    number = F.try_to_number(F.regexp_extract(source, r"(\d{1,9})$", 1), F.lit("999999999"))
    return F.when(number % 3 == 1, "reference").when(number % 3 == 2, "forum").otherwise("web")


def token_count(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _weight(name: Column, weights: dict, default: float) -> Column:
    out = F.lit(float(default))
    for key, value in sorted(weights.items()):
        out = F.when(name.eqNullSafe(F.lit(key)), float(value)).otherwise(out)
    return out


def _fill(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Children (``parent`` columns, ``name``, ``supply``, ``w``, the parent's
    ``budget``) with ``share``: what each gets of the budget."""
    df = children.withColumn("r", F.when(F.col("w") > 0, F.col("supply") / F.col("w")))
    by = Window.partitionBy(*(parent or [F.lit(0)]))
    order = by.orderBy(F.col("r").asc_nulls_last(), name)
    usable = F.when(F.col("w") > 0, F.col("supply")).otherwise(0)
    df = df.withColumns({
        "full": F.coalesce(F.sum(usable).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "rest": F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))})
    # if the children before this one are full: the level of the others
    df = df.withColumn("level", F.when(F.col("rest") > 0, (F.col("budget") - F.col("full")) / F.col("rest")))
    # it holds from the first child on that is not filled up, where it is highest
    df = df.withColumn("level", F.max(F.when(F.col("level") <= F.col("r"), F.col("level"))).over(by))
    supply = F.col("supply").cast("double")
    share = F.when(F.col("w") > 0, F.least(supply, F.coalesce(F.col("level") * F.col("w"), supply))).otherwise(0.0)
    return df.select(*parent, name, F.floor(share + F.lit(1e-6)).cast("long").alias("share"))


def leaf_budgets(leaves: DataFrame, config: MixConfig) -> DataFrame:
    """(domain, lang, source, tokens, docs) with ``budget`` per leaf."""
    weights = {"domain": config.domain_weights, "lang": config.lang_weights, "source": config.source_weights}
    if config.budget_tokens is not None:
        total = config.budget_tokens
    else:
        total = int((leaves.agg(F.sum("tokens").alias("t")).first()["t"] or 0) * config.budget_share)
    parent: list[str] = []
    budgets = None
    for name in LEVELS:
        key = [*parent, name]
        nodes = (leaves.groupBy(*key).agg((F.sum("tokens") * config.max_epochs).alias("supply"))
                 .withColumn("w", _weight(F.col(name), weights[name], config.default_weight)))
        if budgets is None:
            nodes = nodes.withColumn("budget", F.lit(total).cast("long"))
        else:
            above = budgets.select(*[F.col(k).alias(f"__{k}") for k in parent], F.col("share").alias("budget"))
            nodes = nodes.join(above, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in parent])
        budgets = _fill(nodes, parent, name)
        parent = key
    shares = budgets.select(*[F.col(k).alias(f"__{k}") for k in LEVELS], F.col("share").alias("budget"))
    return leaves.join(shares, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in LEVELS]).drop(*[f"__{k}" for k in LEVELS])


def epoch_draw(seed: str, epoch: Column, row_id: Column) -> Column:
    """Place of a document in an epoch: a whole number below 2**52."""
    text = F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(row_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


_LEAF = [f"__{k}" for k in LEVELS]


def _tree_columns(text_col: str, source_col: str, lang_col: str) -> dict[str, Column]:
    return {"__domain": domain_of(F.col(source_col)), "__lang": F.col(lang_col), "__source": F.col(source_col),
            "__tok": token_count(F.col(text_col))}


def _copies(rows: DataFrame, config: MixConfig, id_col: str) -> DataFrame:
    """``rows`` (with the tree columns) plus ``__copies``; rows without a copy left out."""
    leaves = rows.groupBy(*[F.col(c).alias(k) for c, k in zip(_LEAF, LEVELS)]).agg(
        F.sum("__tok").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    tokens = F.greatest(F.col("tokens"), F.lit(1))
    epochs = F.floor(F.col("budget") / tokens)
    plan = materialise(leaf_budgets(materialise(leaves, "mix-leaves"), config).select(
        *[F.col(k).alias(f"p__{k}") for k in LEVELS], epochs.cast("int").alias("__epochs"),
        (F.col("budget") - epochs * tokens).alias("__left"),
        F.ceil(F.col("docs") / config.bucket_rows).cast("long").alias("__buckets")), "mix-plan")
    # no hints: Spark broadcasts the leaf tables while they are small, and splits hot leaves when they are not
    placed = rows.join(plan, [F.col(c).eqNullSafe(F.col(f"p{c}")) for c in _LEAF]).drop(*[f"p{c}" for c in _LEAF])
    placed = placed.withColumn("__draw", epoch_draw(config.seed, F.col("__epochs"), F.col(id_col)))
    # 31 bits of the draw times up to 2**31 buckets stay inside 64 bits
    placed = placed.withColumn("__bucket", F.shiftright(F.shiftright("__draw", 21) * F.col("__buckets"), 31))
    sums = placed.groupBy(*_LEAF, "__bucket", "__left").agg(F.sum("__tok").alias("n"))
    sums = sums.withColumn("upto", F.sum("n").over(Window.partitionBy(*_LEAF).orderBy("__bucket")))
    # the bucket in which the prefix ends, and the tokens before it
    ends = (sums.where(F.col("upto") > F.col("__left")).groupBy(*[F.col(c).alias(f"e{c}") for c in _LEAF])
            .agg(F.min(F.struct(F.col("__bucket").alias("b"), (F.col("upto") - F.col("n")).alias("before"))).alias("end")))
    ends = materialise(ends.select(*[f"e{c}" for c in _LEAF], F.col("end.b").alias("__last"),
                                   F.col("end.before").alias("__before")), "mix-ends")
    marked = (placed.join(ends, [F.col(c).eqNullSafe(F.col(f"e{c}")) for c in _LEAF], "left")
              .drop(*[f"e{c}" for c in _LEAF])
              .withColumn("__last", F.coalesce("__last", F.lit(1 << 62))))
    clear = (marked.where(F.col("__bucket") != F.col("__last"))
             .withColumn("__copies", F.col("__epochs") + (F.col("__bucket") < F.col("__last")).cast("int")))
    running = (Window.partitionBy(*_LEAF, "__bucket").orderBy("__draw", id_col, "__tok")
               .rowsBetween(Window.unboundedPreceding, 0))
    edge = marked.where(F.col("__bucket") == F.col("__last")).withColumn("__sum", F.sum("__tok").over(running))
    edge = edge.withColumn("__copies", F.col("__epochs") + (F.col("__before") + F.col("__sum") <= F.col("__left")).cast("int"))
    return (clear.unionByName(edge.drop("__sum")).where(F.col("__copies") > 0)
            .drop("__epochs", "__left", "__buckets", "__draw", "__bucket", "__last", "__before"))


def choose(docs: DataFrame, config: MixConfig = MixConfig(), id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """One row per chosen row of ``docs``: id, domain, lang, source, n_tokens
    and ``copies``, the number of epochs it is taken in."""
    rows = docs.select(F.col(id_col), *[c.alias(k) for k, c in _tree_columns(text_col, source_col, lang_col).items()])
    out = _copies(materialise(rows, "mix-rows"), config, id_col)
    return out.select(F.col(id_col), *[F.col(c).alias(k) for c, k in zip(_LEAF, LEVELS)],
                      F.col("__tok").alias("n_tokens"), F.col("__copies").cast("int").alias("copies"))


def mix(docs: DataFrame, config: MixConfig = MixConfig(), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """The mixture itself: the chosen rows with all their columns, whatever they
    are called, a row per copy."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"),
                       *[c.alias(k) for k, c in _tree_columns(text_col, source_col, lang_col).items()])
    out = _copies(rows, config, "id")
    return (out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
            .select(*[F.col("row")[c].alias(c) for c in docs.columns]))
