"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Token masses are summed per (source, language, topic) cell. Every level of a dimension has a target: its share of the tokens that are to stay, which are the share
``KEEP`` of all. A cell's probability is the product of three factors, one for each of its levels, and 1 at most; raking goes round the
dimensions and scales each level's factor by its target over what would stay of it, until the three marginals meet their targets. What
cannot meet its target is kept whole (its factor grows until its cells are at 1), and the rest is raked around it; so a rare source, however far
from its target, thins no other. A document stays with its cell's probability.

Everything is DataFrame and SQL expressions over the table of cells, whose number is counted. Up to ``FEW`` of them are raked in one task, by window sums, and
broadcast to the documents. More - sources may be web hosts - are raked by the same steps as tables: sums of each level in parts first, joined back, each
step written out; and documents meet them in a join that splits hot cells. Documents are read twice; nothing of them is shuffled as long as the cells are few.

``SWEEPS`` sweeps are made. How far the marginals then are from their targets is measured, and a warning says so if it is over ``TOLERANCE`` of what stays.

Defined results: null is a level of its own in each dimension; a null or empty text counts as one token, as does any text
without words; a document without an id draws by its text instead; rows with the same id are kept or dropped together;
an empty table gives an empty result; other columns ride along untouched, and names that clash with those added here are replaced.
Levels that targets do not name share what the named ones leave, in their natural proportions; where these leave nothing, levels
without a name keep their natural shares and the named ones share the rest in proportion. Levels with a target of 0 get nothing, and where all targets of a dimension
are 0 nothing stays.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, packed_row, skew_join, stored, unpacked_row

DIMENSIONS = ("source", "lang", "topic")
#: What the query and the pipeline use: a number is the power of the natural share (1 leaves it, 0 evens it out), a mapping names shares.
TARGETS: dict[str, float | Mapping[str, float]] = {"source": 0.5, "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}, "topic": 0.8}
#: Share of all tokens that the targets divide.
KEEP = 0.5
SWEEPS, TOLERANCE = 12, 0.02
SEED = 20
#: Named targets that leave less than this leave nothing.
LEFT = 1e-9
#: The largest factor: that of levels that are whole long since.
MOST = 1e30
#: Cells that are raked in one task and joined to documents by broadcast; a cell is three short names and a few numbers.
FEW = 50_000
#: Words, as the token count of a document. The class is spelt out since engines differ in what \s covers.
WORDS = r"[^ \t\n\r]+"


def token_count(text: Column) -> Column:
    """Words of a text, 1 at least."""
    return F.greatest(F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)), F.lit(1)).cast("long")


def surface_topic(text: Column, tokens: Column) -> Column:
    """The kind of writing, from its marks and length: table, markup, shout, note, article or essay."""

    def marks(mark: str) -> Column:
        return F.coalesce(F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit(""))), F.lit(0))

    return (
        F.when(marks("|") * 10 > tokens, "table")
        .when(marks("%%%") * 10 > tokens, "markup")
        .when(marks("!!") * 4 > tokens, "shout")
        .when(tokens < 100, "note")
        .when(tokens < 1000, "article")
        .otherwise("essay")
    )


def level(name: str) -> Column:
    """A level as a text that is never null: names begin with a mark that null lacks."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def summed(cells: DataFrame, dim: str, value: Column, name: str, few: bool) -> DataFrame:
    """``cells`` with the sum of a value over the level that each is in. A few cells lie in one partition, so a window needs no shuffle; many are summed in parts
    first and joined back, so that a level with very many of them meets in no task."""
    if few:
        return cells.withColumn(name, F.sum(value).over(Window.partitionBy(dim)))
    return skew_join(cells, cells.groupBy(dim).agg(F.sum(value).alias(name)), dim)


def share(cells: DataFrame, dim: str, rule: float | Mapping[str, float], own: Column) -> Column:
    """The target share of a level whose natural share is ``own``."""
    levels = cells.groupBy(dim).agg(F.sum("mass").alias("mass"))
    if not isinstance(rule, Mapping):
        natural = F.col("mass") / F.lit(float(cells.agg(F.sum("mass")).first()[0]))
        return F.pow(own, F.lit(float(rule))) / F.lit(levels.agg(F.sum(F.pow(natural, F.lit(float(rule))))).first()[0])
    known = F.lit(None).cast("double")
    for name, part in rule.items():
        known = F.when(F.col(dim) == "=" + name, F.lit(float(part))).otherwise(known)
    loose_mass = F.sum(F.when(known.isNull(), F.col("mass")))
    given, loose = levels.agg(F.coalesce(F.sum(known), F.lit(0.0)), F.coalesce(loose_mass / F.sum("mass"), F.lit(0.0))).first()
    if given > 1 - LEFT and loose > 0:
        return F.coalesce(known * F.lit((1 - loose) / given), own)
    rest = max(1 - given, 0.0) if loose else 0.0
    whole = given + rest
    return F.coalesce(known, own * F.lit(rest / loose if loose else 0.0)) / F.lit(whole) if whole else F.lit(0.0)


def probabilities(masses: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TARGETS, keep: float = KEEP, sweeps: int = SWEEPS) -> DataFrame:
    """Rakes cells (source, lang, topic as ``level`` has them, mass): adds the probability."""
    cells = durable(masses)
    count, total = cells.agg(F.count("*"), F.sum("mass")).first()
    if not count:
        return cells.withColumn("probability", F.lit(0.0))
    few = count <= FEW
    cells = cells.coalesce(-(-count // FEW))
    state = cells
    for d in DIMENSIONS:
        state = summed(state, d, F.col("mass"), f"whole_{d}", few)
        goal = share(cells, d, targets[d], F.col(f"whole_{d}") / F.lit(float(total))) * F.lit(keep * float(total))
        state = state.withColumns({f"goal_{d}": goal, f"f_{d}": F.lit(float(keep) if d == DIMENSIONS[0] else 1.0)})
    chance = F.least(F.lit(1.0), F.col("f_source") * F.col("f_lang") * F.col("f_topic"))
    for _ in range(sweeps):
        for d in DIMENSIONS:
            scaled = F.least(F.lit(MOST), F.coalesce(F.try_divide(F.col(f"f_{d}") * F.col(f"goal_{d}"), F.col("stays")), F.lit(0.0)))
            state = summed(state, d, F.col("mass") * chance, "stays", few).withColumn(f"f_{d}", scaled).drop("stays")
            if not few:
                state = stored(state, clean=False)
    state = durable(state) if few else state
    # Levels that are not whole should have met their targets.
    off = 0.0
    for d in DIMENSIONS:
        levels = state.groupBy(d).agg(F.sum(F.col("mass") * chance).alias("stays"), F.first(f"whole_{d}").alias("whole"), F.first(f"goal_{d}").alias("goal"))
        off = max(off, levels.where("stays < whole * (1 - 1e-9)").agg(F.max(F.abs(F.col("stays") - F.col("goal")))).first()[0] or 0.0)
    if off > TOLERANCE * keep * total:
        warnings.warn(f"after {sweeps} sweeps a marginal is off by {off / (keep * total):.3f} of what stays", stacklevel=2)
    return state.select(*DIMENSIONS, "mass", chance.alias("probability"))


def sampled(docs: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TARGETS, topic: Column | None = None, keep: float = KEEP, sweeps: int = SWEEPS, seed: int = SEED) -> DataFrame:
    """The sampled rows of ``docs`` (doc_id, text, source, lang and others) as a column row, with their topic, tokens and probability."""
    given = [] if topic is None else [topic.alias("topic")]
    # The row travels as one column, so that no name of its own can clash with those added here.
    counted = docs.select(packed_row(docs.columns), F.col("doc_id").alias("id"), "text", *(level(d).alias(d) for d in ("source", "lang")), token_count(F.col("text")).alias("tokens"), *given)
    if topic is None:
        counted = counted.withColumn("topic", surface_topic(F.col("text"), F.col("tokens")))
    counted = counted.withColumn("kind", F.col("topic")).withColumn("topic", level("topic"))
    cells = probabilities(counted.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("mass")), targets, keep, sweeps)
    cells = cells.where("probability > 0").select(*DIMENSIONS, "probability")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))
    draw = F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    if cells.count() <= FEW:
        joined = counted.join(F.broadcast(cells), [*DIMENSIONS])
    else:
        cell = F.struct(*DIMENSIONS).alias("cell")
        joined = skew_join(counted.withColumn("cell", cell), cells.select(cell, "probability"), "cell")
    return joined.where(draw < F.col("probability")).select("row", F.col("kind").alias("topic"), "tokens", "probability")


def mix(docs: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TARGETS, topic: Column | None = None, keep: float = KEEP, sweeps: int = SWEEPS, seed: int = SEED) -> DataFrame:
    """The sampled rows of ``docs`` (doc_id, text, source, lang and others) with topic, tokens and probability."""
    own = [c for c in docs.columns if c not in ("topic", "tokens", "probability")]
    return sampled(docs, targets, topic, keep, sweeps, seed).select(*unpacked_row(own), "topic", "tokens", "probability")


def rows_of_mix(docs: DataFrame) -> DataFrame:
    """The sampled rows of ``docs`` as they are, with all their columns and no others."""
    return sampled(docs).select(*unpacked_row(docs.columns))


def oracle(targets: Mapping[str, float | Mapping[str, float]] = TARGETS, keep: float = KEEP, sweeps: int = SWEEPS, seed: int = SEED, documents: str = "documents", columns: str = "doc_id, source, lang, topic, tokens, round(probability, 6) AS probability") -> str:
    """DuckDB SQL for ``mix``: the sweeps spelt out one after the other as window sums."""
    marks = lambda mark: f"coalesce(strlen(text) - strlen(replace(text, '{mark}', '')), 0)"
    ctes = [
        f"counted AS (SELECT *, greatest(coalesce(len(regexp_extract_all(text, '{WORDS}')), 0), 1)::BIGINT AS tokens FROM {documents})",
        f"""topical AS (SELECT *, CASE WHEN {marks("|")} * 10 > tokens THEN 'table' WHEN {marks("%%%")} * 10 > tokens THEN 'markup'
 WHEN {marks("!!")} * 4 > tokens THEN 'shout' WHEN tokens < 100 THEN 'note' WHEN tokens < 1000 THEN 'article' ELSE 'essay' END AS topic FROM counted)""",
        "masses AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS mass FROM topical GROUP BY ALL)",
        "shares AS (SELECT *, mass / sum(mass) OVER () AS w FROM masses)",
    ]
    for d in DIMENSIONS:
        ctes.append(f"own_{d} AS (SELECT {d}, sum(w) AS own FROM shares GROUP BY {d})")
        if isinstance(rule := targets[d], Mapping):
            named = "CASE " + " ".join(f"WHEN {d} = '{k}' THEN {float(v)!r}::DOUBLE" for k, v in rule.items()) + " END" if rule else "NULL::DOUBLE"
            ctes.append(f"named_{d} AS (SELECT *, {named} AS known FROM own_{d})")
            ctes.append(f"left_{d} AS (SELECT *, coalesce(sum(known) OVER (), 0) AS given, coalesce(sum(CASE WHEN known IS NULL THEN own END) OVER (), 0) AS loose FROM named_{d})")
            ctes.append(
                f"raw_{d} AS (SELECT {d}, CASE WHEN given > {1 - LEFT!r} AND loose > 0 THEN coalesce(known * (1 - loose) / given, own) ELSE coalesce(known, own * greatest(1 - given, 0) / loose) END AS raw FROM left_{d})"
            )
        else:
            ctes.append(f"raw_{d} AS (SELECT {d}, pow(own, {float(rule)!r}) AS raw FROM own_{d})")
        ctes.append(f"to_{d} AS (SELECT {d}, raw / sum(raw) OVER () AS t FROM raw_{d})")
    start = ", ".join(f"to_{d}.t * {keep!r} * sum(mass) OVER () AS t_{d}, {keep if d == DIMENSIONS[0] else 1.0!r}::DOUBLE AS f_{d}" for d in DIMENSIONS)
    ctes.append(f"k AS (SELECT shares.*, {start} FROM shares " + " ".join(f"JOIN to_{d} ON shares.{d} IS NOT DISTINCT FROM to_{d}.{d}" for d in DIMENSIONS) + ")")
    last, chance = "k", "least(1, f_source * f_lang * f_topic)"
    for i in range(sweeps):
        for d in DIMENSIONS:
            ctes.append(f"k{i}_{d} AS MATERIALIZED (SELECT * REPLACE (least({MOST!r}, coalesce(f_{d} * t_{d} / nullif(sum(mass * {chance}) OVER (PARTITION BY {d}), 0), 0)) AS f_{d}) FROM {last})")
            last = f"k{i}_{d}"
    ctes.append(f"cells AS (SELECT source, lang, topic, {chance} AS probability FROM {last})")
    draw = f"('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 12))::BIGINT / {float(16**12)!r}"
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {columns} FROM topical t JOIN cells c ON t.source IS NOT DISTINCT FROM c.source AND t.lang IS NOT DISTINCT FROM c.lang AND t.topic IS NOT DISTINCT FROM c.topic WHERE {draw} < probability".replace("SELECT doc_id, source, lang, topic,", "SELECT t.doc_id, t.source, t.lang, t.topic,")
