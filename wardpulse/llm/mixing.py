"""Mixing sources to target weights by hierarchical budgets.

The corpus is a tree domain -> language -> source; a leaf can give its tokens
``max_epochs`` times.  The token budget flows down: a node's budget is split
over its children by weight, no child above what it can give, and what a short
child leaves goes to its siblings (a water level found with running sums).  A
node never gets more than it can give, so only a shortage of a whole family
reaches the node's own siblings, one level up.

A leaf takes whole epochs and a prefix of one more; each epoch orders the
leaf's documents by its own seeded hash.  A document belongs to the prefix when
the tokens before it are under the budget.  Prefixes are cut in two steps, so
that no task sees a whole leaf: hash buckets are summed and cut first, and only
the bucket in which the budget ends is ordered by document.

All of it is DataFrame functions; token counts, weights and budgets are
integers and the split is exact.

Defined cases: null domain, language or source are the value ''; null text has
no tokens; a leaf without tokens gives nothing; ties in the hash order go by
id, then by text; null ids order first; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardpulse.llm.rows import KEY, keep_rows, row_key, shared_table, text_or_empty

LEVELS = ("domain", "lang", "source")
BUCKET_CHARS = 3


def n_tokens(text_col: str) -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_domain(source_col: str = "source", domains: int = 4) -> Column:
    """Domain of a numbered source; sources without a number are domain ''."""
    number = F.regexp_extract(F.coalesce(F.col(source_col).cast("string"), F.lit("")),
                              "([0-9]{1,9})$", 1)
    return F.when(number == "", "").otherwise(
        F.concat(F.lit("d"), (number.try_cast("long") % domains).cast("string")))


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1)
    for value, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, w).otherwise(out)
    return out.cast("decimal(38,0)")


def _share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Split ``__budget`` (on every child of one parent) over children with
    ``__cap`` and ``__w`` -> ``__given``."""
    order = (F.col("__cap").cast("double") / F.col("__w").cast("double"), F.col(name))
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    line = family.orderBy(*order)
    before = F.coalesce(F.sum("__cap").over(line.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0)).cast("decimal(38,0)")
    weight = F.sum("__w").over(line.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    nodes = nodes.withColumn("__before", before).withColumn(
        "__weight", weight.cast("decimal(38,0)"))
    nodes = nodes.withColumn("__full", F.expr(
        "cast(__cap as decimal(38,0)) * cast(__weight as decimal(20,0)) <= "
        "(cast(__budget as decimal(38,0)) - __before) * cast(__w as decimal(20,0))"))
    nodes = (nodes.withColumn("__taken", F.coalesce(F.sum(F.expr("if(__full, __cap, 0)")).over(family), F.lit(0)))
             .withColumn("__open", F.sum(F.expr("if(__full, 0, __w)")).over(family)))
    return nodes.withColumn("__given", F.expr(
        "if(__full, __cap, cast((cast(__budget - __taken as decimal(38,0)) * cast(__w as decimal(18,0)))"
        " div cast(__open as decimal(38,0)) as bigint))")).drop(
        "__before", "__weight", "__full", "__taken", "__open", "__w", "__budget")


def leaf_budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], permille: int,
                 max_epochs: int) -> DataFrame:
    """(domain, lang, source, __tokens) -> the same with ``__given`` tokens; the
    whole budget is ``permille`` thousandths of the tokens there are."""
    leaves = leaves.withColumn("__cap", F.col("__tokens") * F.lit(max_epochs))
    budget = leaves.agg(F.expr(f"cast(coalesce(sum(__tokens), 0) * {permille} div 1000 as bigint)")
                        .alias("__budget"))
    above = None
    for i, name in enumerate(LEVELS):
        path = list(LEVELS[:i + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("__cap").alias("__cap"),
                                          F.sum("__tokens").alias("__tokens"))
        nodes = nodes.withColumn("__w", _weight(name, weights))
        if above is None:
            nodes = nodes.crossJoin(F.broadcast(budget))  # one row
        else:
            nodes = nodes.join(above.select(*path[:-1], F.col("__given").alias("__budget")),
                               path[:-1])
        above = _share_out(nodes, path[:-1], name)
    return above


def mix_sources(docs: DataFrame, weights: dict[str, dict[str, int]], permille: int = 1000,
                max_epochs: int = 1, seed: int = 0, domain: Column | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per chosen (row, epoch): id, domain, lang, source, epoch,
    n_tokens, leaf_budget, KEY.  ``weights`` maps a level to the weight (a
    positive integer) of its values; values not named weigh 1."""
    empty = F.lit("")
    domain = source_domain() if domain is None else domain
    rows = shared_table(docs.select(
        F.col(id_col).alias("__id"), row_key(id_col, text_col).alias(KEY),
        F.coalesce(domain, empty).alias("domain"),
        *[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in LEVELS[1:]],
        n_tokens(text_col).alias("__n")), "mix-rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("__n").alias("__tokens"))
    given = leaf_budgets(leaves, weights, permille, max_epochs).filter(
        "__tokens > 0 and __given > 0").withColumn(
        "__whole", F.expr("__given div __tokens")).withColumn(
        "__rest", F.expr("__given % __tokens"))
    given = shared_table(given.drop("__cap"), "mix-leaves")

    epochs = F.sequence(F.lit(0).cast("long"),
                        F.col("__whole") + F.when(F.col("__rest") > 0, 0).otherwise(-1))
    taken = rows.join(given, list(LEVELS)).withColumn(
        "epoch", F.explode(F.filter(epochs, lambda e: (e >= 0) & (
            (e < F.col("__whole")) | (F.col("__rest") > 0)))))
    whole = taken.filter("epoch < __whole")
    part = taken.filter("epoch = __whole").withColumn(
        "__h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"),
                                 F.col("__id").cast("string")))).withColumn(
        "__bucket", F.substring("__h", 1, BUCKET_CHARS))
    sums = part.groupBy(*LEVELS, "__bucket", "__rest").agg(F.sum("__n").alias("__sum"))
    run = Window.partitionBy(*LEVELS).orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    cut = (sums.withColumn("__before", F.coalesce(F.sum("__sum").over(run), F.lit(0)))
           .filter("__before < __rest")
           .withColumn("__inside", F.expr("__before + __sum <= __rest"))
           .select(*LEVELS, "__bucket", "__before", "__inside"))
    part = part.join(cut, [*LEVELS, "__bucket"])
    inside = part.filter("__inside")
    line = Window.partitionBy(*LEVELS).orderBy("__h", "__id", KEY).rowsBetween(
        Window.unboundedPreceding, -1)
    edge = (part.filter("not __inside")
            .withColumn("__run", F.col("__before") + F.coalesce(F.sum("__n").over(line), F.lit(0)))
            .filter("__run < __rest"))
    cols = [F.col("__id").alias(id_col), *LEVELS, F.col("epoch").cast("int").alias("epoch"),
            F.col("__n").alias("n_tokens"), F.col("__given").alias("leaf_budget"), KEY]
    return whole.select(*cols).union(inside.select(*cols)).union(edge.select(*cols))


def draw(docs: DataFrame, weights: dict[str, dict[str, int]], permille: int, seed: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The chosen rows of ``docs`` for one epoch at most, all columns."""
    keys = mix_sources(docs, weights, permille, 1, seed, id_col=id_col, text_col=text_col)
    return keep_rows(docs, keys.select(F.col(id_col).alias("__id"), KEY), id_col, text_col)
