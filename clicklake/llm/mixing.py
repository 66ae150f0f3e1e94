"""Sources mixed to target weights: exact block quotas split over output shards, blocks drawn without replacement.

1. A source's documents, in an order given by hashes, make one axis of words, cut into blocks of ``block`` words.
2. A source's target gives its quota of blocks: whole passes over all its blocks, and a part of one more pass.
3. A splitting tree deals the quotas out. Its root holds the quotas of all sources; a node gives half of its blocks to either
   child, the numbers by source being a multivariate hypergeometric draw (one hypergeometric draw for each source, given those
   before it). Sums stay exact at every node, so the leaves, the output shards, hold all quotas and are of equal size within one block a level.
4. A source's draws are its blocks in permuted order, pass after pass. Each shard owns a range of that order by its quota, so shards draw
   disjoint blocks, and it shuffles its draws among themselves.

All of it is DataFrame expressions. Orders within a source are found in ranges of the hash, so a source with a third of all words is
ordered in many tasks; only the table of quotas (a row for each tree node, an entry for each source) is handled as arrays.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.llm.common import unit, written

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 64
SHARE = 1.5
CAP = 2.0
RANGE_ROWS = 2_000
SHARD_BLOCKS = 1 << 16
TRIES = 48


def _place(*parts: Column) -> Column:
    """A number in [0, 2**52) from an MD5; SQL engines agree on it."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def _range_of(place: Column, ranges: Column) -> Column:
    """Which of equally wide ranges a place is in; rises with the place."""
    return F.floor(place / F.lit(float(1 << 52)) * ranges).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, place): the words of each row's text, and where its hash puts it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    place = _place(F.lit("document"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text))
    return docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), place.alias("place"))


def targets(sized: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, docs, source_size, target): ``weights``, repeating over the sources in order of code points (null last), share
    ``share`` times all words; a target stops at ``cap`` times its source's size, and the excess goes to the others by weight.

    That is min(cap * size, level * weight) for the one level at which the targets add up. The sources with the least room for their
    weight stop first: sorted by it, the level that is left for the others rises to the right one and falls after it. One row for each source is sorted in one task.
    """
    stats = sized.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    row = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(row - 1, F.lit(len(weights))) + 1).cast("int"))
    stats = stats.withColumn("weight", weight).withColumn("most", F.col("source_size") * cap)
    by_room = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("total", F.sum("source_size").over(Window.partitionBy()) * share)
    stats = stats.withColumn("used", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
    rest = F.sum("weight").over(by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    stats = stats.withColumn("level", (F.col("total") - F.col("used")) / rest)
    stats = stats.withColumn("level", F.when(F.col("level") * F.col("weight") < F.col("most"), F.col("level")))
    stats = stats.withColumn("level", F.max("level").over(Window.partitionBy()))
    target = F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return stats.select("source", "docs", "source_size", target.alias("target"))


def _log_factorial(n: Column) -> Column:
    """ln(n!) by Stirling's series at n + 8, brought back; exact to about 1e-12 of its size."""
    x = n + F.lit(9.0)
    series = (x - 0.5) * F.log(x) - x + F.lit(0.5 * math.log(2 * math.pi)) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    back = n + 1
    for k in range(2, 9):
        back = back * (n + float(k))
    return series - F.log(back)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hypergeometric(good: Column, bad: Column, drawn: Column, seed: list[Column]) -> Column:
    """How many of ``drawn`` items, taken without replacement from ``good`` + ``bad``, are good.

    Ratio of uniforms (Stadlober 1990): a try is accepted with the true probability, so accepted values are exact draws. The uniforms come
    from a hash of the seed. That all tries fail has a chance under 1e-12; then the mode is taken.
    """
    total = good + bad
    least, most = F.greatest(F.lit(0.0), drawn - bad), F.least(good, drawn)
    mean = drawn * good / F.greatest(total, F.lit(1.0))
    spread = mean * bad / F.greatest(total, F.lit(1.0)) * (total - drawn) / F.greatest(total - 1, F.lit(1.0))
    mode = F.least(most, F.greatest(least, F.floor((drawn + 1) * (good + 1) / (total + 2)).cast("double")))
    width = F.lit(2 * math.sqrt(2 / math.e)) * F.sqrt(F.greatest(spread, F.lit(0.0)) + 0.5) + F.lit(3 - 2 * math.sqrt(3 / math.e))

    def weigh(x: Column, g: Column, b: Column, d: Column) -> Column:
        parts = F.transform(F.array(x, g - x, d - x, b - d + x), _log_factorial)
        return F.aggregate(parts, F.lit(0.0), lambda a, y: a + y)

    def search(c: Column) -> Column:
        def attempt(found: Column, k: Column) -> Column:
            u, v = unit(*seed, k, F.lit("u")) + F.lit(1e-300), unit(*seed, k, F.lit("v"))

            def judge(t: Column) -> Column:
                below = F.log(t["u"]) * 2 <= c["peak"] - weigh(t["x"], c["good"], c["bad"], c["drawn"])
                return F.when((t["x"] >= c["least"]) & (t["x"] <= c["most"]), F.when(below, t["x"]))

            tried = _bound(u, lambda w: F.struct(w.alias("u"), F.floor(c["mean"] + 0.5 + c["width"] * (v - 0.5) / w).cast("double").alias("x")))
            return F.when(found.isNotNull(), found).otherwise(_bound(tried, judge))

        return F.coalesce(F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("double"), attempt), c["mode"])

    known = F.struct(
        good.alias("good"), bad.alias("bad"), drawn.alias("drawn"), least.alias("least"), most.alias("most"),
        mean.alias("mean"), width.alias("width"), mode.alias("mode"), weigh(mode, good, bad, drawn).alias("peak"),
    )
    return F.when(least >= most, least).otherwise(_bound(known, search))


def _split(quotas: Column, node: Column, seed: int) -> Column:
    """The left child's quotas: half of all the node's blocks, source by source, each given the ones before."""
    total = F.aggregate(quotas, F.lit(0.0), lambda a, q: a + q)
    start = F.struct(
        total.alias("rest"), F.ceil(total / 2).cast("double").alias("drawn"), F.array().cast("array<double>").alias("left")
    )

    def step(a: Column, q: Column) -> Column:
        got = _hypergeometric(q, a["rest"] - q, a["drawn"], [F.lit(seed), node, F.size(a["left"])])
        return _bound(got, lambda x: F.struct((a["rest"] - q).alias("rest"), (a["drawn"] - x).alias("drawn"), F.concat(a["left"], F.array(x)).alias("left")))

    return F.aggregate(quotas, start, step, lambda a: a["left"])


def shard_quotas(quotas: DataFrame, levels: int, seed: int = 1) -> DataFrame:
    """(shard, source, quota) from (source, quota): the leaves of the splitting tree."""
    one = F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", F.col("quota").cast("double").alias("quota"))))
    nodes = quotas.agg(one.alias("s")).select(F.lit(1).cast("long").alias("node"), F.col("s.source").alias("sources"), F.col("s.quota").alias("quotas"))
    for _ in range(levels):
        nodes = nodes.withColumn("left", F.explode(F.array(_split(F.col("quotas"), F.col("node"), seed))))
        right = F.zip_with("quotas", "left", lambda q, x: q - x)
        children = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas")),
            F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("quotas")),
        )
        nodes = nodes.select("sources", F.explode(children).alias("c")).select("c.node", "sources", "c.quotas")
    leaves = nodes.select((F.col("node") - (1 << levels)).alias("shard"), F.explode(F.arrays_zip("sources", "quotas")).alias("e"))
    return leaves.select("shard", F.col("e.sources").alias("source"), F.col("e.quotas").cast("long").alias("quota"))


def _ranked(frame: DataFrame, order: list[Column], amount: Column, name: str) -> DataFrame:
    """``frame`` (source, range, ...) with ``name``: the sum of ``amount`` over the rows of the source before it in (range, order)."""
    inside = Window.partitionBy("source", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = frame.groupBy("source", "range").agg(F.sum(amount).alias("_sum"))
    over = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(over), F.lit(0))).drop("_sum")
    rows = frame.withColumn("_own", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    same = (rows["source"].eqNullSafe(sums["source"])) & (rows["range"] == sums["range"])
    return rows.join(sums, same).select(*[rows[c] for c in frame.columns], (F.col("_own") + F.col("_base")).alias(name))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = SHARE,
    cap: float = CAP,
    block: int = BLOCK,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """(draws, documents) of a mix of ``docs`` (doc_id, source, text; other columns are not used).

    draws: shard, position (in the shuffled shard), doc_id, place (the row's hash), source, pass, block, first_word, n_words; one
    row for each part of a drawn block that lies in one document. documents: doc_id, place, size, source, source_size, target; one row
    for each row of ``docs``. A source's draws come within a block of its target; no document is drawn more than ``cap`` = 2 times.
    Null sources are a source, the last one; null and blank texts have no words and are never drawn; rows alike in id and text share a place
    and are told apart by their order only; an empty table gives no rows. Runs over equal tables agree.
    """
    sized = written(sizes(docs), "mix-sizes")
    goals = written(targets(sized, weights, share, cap), "mix-targets")
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("long")
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    rest = F.round((F.col("target") - whole * F.col("source_size")) / block).cast("long")
    plans = goals.withColumn("blocks", blocks).withColumn("quota", whole * blocks + F.least(blocks, rest))
    total = plans.agg(F.sum("quota")).first()[0] or 0
    levels = max(0, math.ceil(math.log2(max(1, total) / shard_blocks)))

    def with_goal(frame: DataFrame, *columns: str) -> DataFrame:
        goal = plans.select(F.col("source").alias("_s"), *columns)
        return frame.join(goal, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")

    documents = with_goal(sized, "docs", "source_size", "target")
    spread = documents.where("size > 0").withColumn("range", _range_of(F.col("place"), F.ceil(F.col("docs") / RANGE_ROWS)))
    axis = _ranked(spread.select("doc_id", "place", "source", "size", "range"), [F.col("place"), F.col("doc_id"), F.col("size")], F.col("size"), "start")
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    parts = axis.select("doc_id", "place", "source", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.lit(0), F.col("block") * block - F.col("start"))
    end = F.least(F.col("size"), (F.col("block") + 1) * block - F.col("start"))
    parts = parts.select("doc_id", "place", "source", "start", "block", begin.alias("first_word"), (end - begin).alias("n_words"))
    parts = parts.withColumn("opens", (F.col("start") + F.col("first_word") == F.col("block") * block).cast("long"))
    parts = parts.withColumn("at", _place(F.lit(f"block{seed}"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")), F.col("block").cast("string")))
    parts = with_goal(parts, "blocks", "quota").withColumn("range", _range_of(F.col("at"), F.ceil(F.col("blocks") / RANGE_ROWS)))
    parts = written(parts.drop("start"), "mix-parts")
    # A block's part that opens it stands first among the parts of its block, so all of them have as many opened blocks up to themselves.
    ranked = _ranked(parts, [F.col("at"), F.col("block"), F.col("opens").desc(), F.col("place"), F.col("doc_id"), F.col("first_word")], F.col("opens"), "opened")
    ranked = ranked.withColumn("rank", F.col("opened") + F.col("opens") - 1)
    passes = F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - 1 - F.col("rank")) / F.col("blocks")))
    drawn = ranked.where("rank < quota").withColumn("pass", F.explode(passes)).withColumn("draw", F.col("pass") * F.col("blocks") + F.col("rank"))

    shards = shard_quotas(plans.where("quota > 0").select("source", "quota"), levels, seed)
    upto = Window.partitionBy("source").orderBy("shard")
    shards = shards.withColumn("high", F.sum("quota").over(upto)).withColumn("low", F.col("high") - F.col("quota")).where("quota > 0")
    # Draws find the shard that owns them by equal cells of the source's order, about as many as shards.
    wide = plans.select(F.col("source").alias("_s"), F.greatest(F.lit(1), F.floor(F.col("quota") / (1 << levels))).cast("long").alias("cell_size"))
    shards = shards.join(wide, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    cells = F.sequence(F.floor(F.col("low") / F.col("cell_size")), F.floor((F.col("high") - 1) / F.col("cell_size")))
    owned = shards.select(F.col("source").alias("_s"), "shard", "low", "high", F.explode(cells).alias("_c"))
    drawn = drawn.withColumn("cell", F.floor(F.col("draw") / F.greatest(F.lit(1), F.floor(F.col("quota") / (1 << levels)))))
    found = drawn.join(owned, F.col("source").eqNullSafe(F.col("_s")) & (F.col("cell") == F.col("_c")) & (F.col("draw") >= F.col("low")) & (F.col("draw") < F.col("high")))
    shuffled = Window.partitionBy("shard").orderBy("turn", "source", "draw", "place", "doc_id", "first_word")
    found = found.withColumn("turn", F.xxhash64(F.lit(seed), "shard", "source", "draw"))
    draws = found.select(
        "shard", F.row_number().over(shuffled).alias("position"), "doc_id", "place", "source", "pass", "block", "first_word", "n_words"
    )
    return draws, documents.drop("docs")


def taken(draws: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each of ``documents``.

    Rows alike in id, source and text cannot be told apart, so they share what was drawn of them evenly, the first getting the odd words.
    """
    key = ["doc_id", "place", "source", "size"]
    got = draws.groupBy("doc_id", "place", "source").agg(F.sum("n_words").alias("words"))
    rows = documents.groupBy(*key, "source_size", "target").agg(F.count(F.lit(1)).alias("alike"))
    same = rows["doc_id"].eqNullSafe(got["doc_id"]) & (rows["place"] == got["place"]) & rows["source"].eqNullSafe(got["source"])
    rows = rows.join(got, same, "left").select(*[rows[c] for c in rows.columns], F.coalesce("words", F.lit(0)).alias("words"))
    rows = rows.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("alike"))))
    share = F.floor(F.col("words") / F.col("alike")) + (F.col("nth") <= F.col("words") % F.col("alike")).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", share.alias("taken"))


def mixed_documents(docs: DataFrame, **settings: object) -> DataFrame:
    """The mix as rows with the columns of ``docs``: for each pass, a drawn document's text, or the runs of it that were drawn.

    Neighbouring drawn parts of a document are one row; its text keeps the white space between its words. A column n_chars, if there
    is one, is the length of the new text; all other columns are the document's. Rows whose id is null or repeated are told apart by
    their text; of rows alike in id, source and text, one stands for all with what was drawn of each.
    """
    draws, documents = mix(docs, **settings)
    parts = F.sort_array(F.collect_list(F.struct("first_word", "n_words")))

    def joined(runs: Column, part: Column) -> Column:
        before = F.element_at(runs, -1)
        grown = F.struct(before["first_word"].alias("first_word"), (before["n_words"] + part["n_words"]).alias("n_words"))
        touches = (F.size(runs) > 0) & (F.try_element_at(runs, F.lit(-1))["first_word"] + F.try_element_at(runs, F.lit(-1))["n_words"] == part["first_word"])
        return F.when(touches, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(grown))).otherwise(F.concat(runs, F.array(part)))

    runs = F.aggregate(parts, F.array().cast("array<struct<first_word:bigint,n_words:bigint>>"), joined)
    spans = draws.groupBy("doc_id", "place", "source", "pass").agg(runs.alias("runs"))
    spans = spans.groupBy("doc_id", "place", "source").agg(F.flatten(F.collect_list("runs")).alias("_runs"))
    spans = spans.select(F.col("doc_id").alias("_i"), F.col("place").alias("_p"), F.col("source").alias("_s"), "_runs")
    text = F.coalesce(F.col("text"), F.lit(""))
    at = _place(F.lit("document"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text))
    rows = docs.withColumn("_at", at)
    if not documents.groupBy("doc_id", "place", "source").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "_at", "source"])
    same = F.col("_at").eqNullSafe(F.col("_p")) & F.col("doc_id").eqNullSafe(F.col("_i")) & F.col("source").eqNullSafe(F.col("_s"))

    def cut(words: Column) -> Column:
        part = lambda run: F.concat_ws("", F.slice(words, (run["first_word"] + 1).cast("int"), run["n_words"].cast("int")))
        return F.transform("_runs", lambda run: F.rtrim(part(run), F.lit(" \t\n\x0b\f\r")))

    # The words of a text are found once, however many runs were drawn of it.
    cuts = _bound(F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0)), cut)
    rows = rows.join(spans, same).withColumn("text", F.explode(cuts))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)
