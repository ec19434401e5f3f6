"""Line dedup by a suffix array over line ids, built by prefix doubling.

Every line that is not blank is a symbol, every document a sequence. Level k ranks the
suffixes by their first 2**k lines; the next level ranks pairs of ranks, of the suffix
itself and of the one 2**k lines further on. Suffixes of equal rank stand side by side in
the suffix array and form an interval of a longest common prefix of at least 2**k lines.
A suffix that is alone, or ends before, is sorted already and leaves, so each level is
smaller than the one before. A binary descent through the levels gives every suffix the exact
length that it has in common with an earlier place. Where that cannot be made longer at
either end, it is a maximal repeated run, and the later copies of such runs are deleted.

All of it is DataFrame operations. A rank is given per interval, not per row, so a line that
a third of all rows share is one row to rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracecurate.operators.numbering import number_rows

from .common import narrow, stored

_PLACE = ("doc", "version", "pos")
MIN_LINES = 3
MIN_WORDS = 25


def _version(text: str = "text") -> Column:
    """Tells apart rows of one id; rows equal in both are one document."""
    return F.xxhash64(text)


def _symbols(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, version, pos, line_no, long, symbol) of the lines that are not blank; ``long`` ones
    have ``min_words`` words or more."""
    line = F.col("x.line")
    # Fewer characters than this cannot be as many words.
    long = (F.length(line) >= 2 * min_words - 1) & (F.size(F.split(line, "[ \\t\\r\\x0B\\f]+")) >= min_words)
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line_no"), F.btrim(x, F.lit(" \t\r")).alias("line")))
    rows = narrow(docs, doc=id_col, text=text_col).where("text is not null")
    return rows.select("doc", _version().alias("version"), F.posexplode(F.filter(lines, lambda x: x["line"] != "")).alias("pos", "x")).select(
        *_PLACE, F.col("x.line_no").alias("line_no"), long.alias("long"), F.unhex(F.md5("x.line")).alias("symbol")
    )


def _intervals(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows whose keys occur more than once, with the rank of their interval and whether an
    earlier row is in it."""
    place = F.struct(*_PLACE)
    groups = stored(rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1"), f"{name}-intervals")
    ranked = number_rows(groups, *keys, name="rank").select(*[F.col(k).alias(f"_{k}") for k in keys], "rank", "first")
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(key) == F.col(f"_{key}"))
    kept = [c for c in rows.columns if c not in keys]
    return rows.join(ranked, same).select(*kept, "rank", (place > F.col("first")).alias("later"))


def _beside(level: DataFrame, offset: int) -> DataFrame:
    """Each suffix of a level with the rank of the one ``offset`` lines further on, if that
    is in the level too."""
    further = level.select(F.col("doc").alias("_doc"), F.col("version").alias("_version"), (F.col("pos") - offset).alias("_pos"), F.col("rank").alias("r2"))
    own = level.select(*_PLACE, F.col("rank").alias("r1"))
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version")) & (F.col("pos") == F.col("_pos"))
    return own.join(further, same).select(*_PLACE, "r1", "r2")


def suffix_levels(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> list[DataFrame]:
    """Levels 0, 1, .. of the suffix array over all repeated lines, each (doc, version, pos,
    rank, later), level 0 with line_no and long; the last is the deepest that has an interval."""
    symbols = stored(_symbols(docs, min_words, id_col, text_col), "symbols")
    first = stored(_intervals(symbols, ["symbol"], "level-0").dropDuplicates(list(_PLACE)), "level-0")
    levels = [first]
    while not levels[-1].isEmpty():
        k = len(levels)
        pairs = stored(_beside(levels[-1], 2 ** (k - 1)), f"pairs-{k}")
        levels.append(stored(_intervals(pairs, ["r1", "r2"], f"level-{k}"), f"level-{k}"))
    return levels[:-1] or levels


def copied_lengths(levels: list[DataFrame]) -> DataFrame:
    """(doc, version, pos, length) of every suffix whose first lines also stand in an earlier
    place: the greatest number of lines for which that holds.

    A problem is a set of suffixes with ``length`` lines in common; each but the smallest, its
    ``head``, waits for its own length. It starts as an interval of level k without the
    suffixes that have an earlier copy of 2**(k + 1) lines. The step down to level j groups it by
    the rank ``length`` lines further on. Suffixes later than the first of their group have
    2**j lines more, in a problem with that first as head; the firsts stand for their groups in
    what is left, as all of a group have the same length in common with those outside. Each
    suffix waits in one problem, so no step has more than twice the rows of its level.
    """
    place = F.struct(*_PLACE)
    beyond = lambda j: levels[j].select(*[F.col(c).alias(f"_{c}") for c in _PLACE], F.col("rank").alias("next"))
    waiting = None
    for k in range(len(levels) - 1, -1, -1):
        if waiting is not None:
            heads = waiting.select("length", "head").distinct().select("head.*", "length", "head")
            members = waiting.unionByName(heads)
            further = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version")) & (F.col("pos") + F.col("length") == F.col("_pos"))
            stepped = stored(members.join(beyond(k), further, "left").select(*_PLACE, "length", "head", "next"), f"step-{k}")
            groups = stepped.where("next is not null").groupBy("length", "head", "next").agg(F.count("*").alias("n"), F.min(place).alias("first"))
            groups = groups.where("n > 1").select(*[F.col(c).alias(f"_{c}") for c in ("length", "head", "next")], "first")
            same = (F.col("next") == F.col("_next")) & (F.col("length") == F.col("_length")) & (F.col("head") == F.col("_head"))
            grouped = stepped.join(groups, same, "left").withColumn("more", F.coalesce(place > F.col("first"), F.lit(False)))
            waiting = grouped.where(F.col("more") | (place != F.col("head"))).select(
                *_PLACE,
                F.when(F.col("more"), F.col("length") + 2**k).otherwise(F.col("length")).alias("length"),
                F.when(F.col("more"), F.col("first")).otherwise(F.col("head")).alias("head"),
            )
        own = levels[k]
        if k + 1 < len(levels):
            deeper = levels[k + 1].where("later").select(*[F.col(c).alias(f"_{c}") for c in _PLACE])
            same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version")) & (F.col("pos") == F.col("_pos"))
            own = own.join(deeper, same, "left_anti")
        # The first of an interval has no earlier copy there, so it is among the rows of ``own``.
        heads = own.where("not later").select(F.col("rank").alias("_rank"), place.alias("head"))
        own = own.where("later").join(heads, F.col("rank") == F.col("_rank")).select(*_PLACE, F.lit(2**k).alias("length"), "head")
        waiting = stored(own if waiting is None else waiting.unionByName(own), f"lengths-{k}")
    return waiting.select(*_PLACE, "length")


def repeated_runs(levels: list[DataFrame]) -> DataFrame:
    """(doc, version, pos, length) of all runs of lines that also stand in an earlier place and
    can be made longer at neither end."""
    before = W.partitionBy("doc", "version").orderBy("pos")
    last = F.lag(F.struct("pos", "length")).over(before)
    lengths = copied_lengths(levels).withColumn("last", last)
    inner = (F.col("last.pos") == F.col("pos") - 1) & (F.col("last.length") == F.col("length") + 1)
    return lengths.where(~F.coalesce(inner, F.lit(False))).select(*_PLACE, "length")


def _flags(removed: DataFrame) -> DataFrame:
    """(doc, version, gone, n_removed, n_runs) from the lines to remove: ``gone`` flags the lines
    of a document, up to the last that goes."""
    removed = removed.groupBy("doc", "version").agg(F.sort_array(F.collect_list(F.struct("line_no", "pos"))).alias("r"))
    kept_before = lambda x, i: x["line_no"] - F.when(i > 0, F.col("r")[i - 1]["line_no"] + 1).otherwise(0)
    flags = F.flatten(F.transform("r", lambda x, i: F.concat(F.array_repeat(F.lit(False), kept_before(x, i)), F.array(F.lit(True)))))
    starts = F.filter("r", lambda x, i: (i == 0) | (x["pos"] != F.col("r")[F.greatest(i - 1, F.lit(0))]["pos"] + 1))
    return removed.select("doc", "version", flags.alias("gone"), F.size("r").alias("n_removed"), F.size(starts).alias("n_runs"))


def _cuts(docs: DataFrame, min_lines: int, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(_doc, _version, gone, n_removed, n_runs, longest_run) of documents with a repeated line,
    ``gone`` as in ``_flags`` for the lines to delete."""
    levels = suffix_levels(docs, min_words, id_col, text_col)
    runs = stored(repeated_runs(levels), "runs")
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version"))
    sizes = narrow(docs, _doc=id_col, text=text_col).where("text is not null").select("_doc", _version().alias("_version"), _solid_lines().alias("lines")).distinct()
    short = runs.where(F.col("length") < min_lines)
    whole = (F.col("length") == F.col("lines")) & (F.col("pos") == 0)
    # A short run has fewer than min_lines lines to look at.
    looked = short.select("*", F.explode(F.sequence("pos", F.col("pos") + F.col("length") - 1)).alias("_pos"))
    long = levels[0].where("long").select(F.col("doc").alias("_doc"), F.col("version").alias("_version"), F.col("pos").alias("_pos"))
    there = F.col("a.doc").eqNullSafe(F.col("b._doc")) & (F.col("a.version") == F.col("b._version")) & (F.col("a._pos") == F.col("b._pos"))
    wordy = looked.alias("a").join(long.alias("b"), there, "left_semi")
    going = runs.where(F.col("length") >= min_lines).unionByName(short.join(sizes, same & whole, "left_semi")).unionByName(wordy.select(runs.columns))
    going = going.distinct()
    # Later runs end later, so lines that two runs share are taken with the first.
    ended = F.lag(F.col("pos") + F.col("length")).over(W.partitionBy("doc", "version").orderBy("pos"))
    start = F.greatest("pos", F.coalesce(ended, F.lit(0)))
    spans = going.withColumn("start", start)
    inside = spans.select(F.col("doc").alias("_doc"), F.col("version").alias("_version"), F.explode(F.sequence("start", F.col("pos") + F.col("length") - 1)).alias("_pos"))
    removed = levels[0].join(inside, same & (F.col("pos") == F.col("_pos"))).select(*_PLACE, "line_no")
    longest = runs.groupBy("doc", "version").agg(F.max("length").alias("longest_run")).withColumnsRenamed({"doc": "_doc", "version": "_version"})
    return longest.join(_flags(removed), same, "left").select("_doc", "_version", "gone", "n_removed", "n_runs", "longest_run")


def _solid_lines() -> Column:
    return F.size(F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(" \t\r")) != ""))


def dedup_runs(
    docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text, n_lines, n_removed, n_runs, longest_run) for every row of ``docs``.

    From ``text`` the maximal runs of lines are gone that also stand in an earlier place, if they
    have ``min_lines`` lines or a line of ``min_words`` words, and all lines of a document that as a
    whole stands in an earlier place, however short it is. So with 3 and 25 every repeated run
    of more than 50 words goes, and a short line that recurs in other surroundings stays.

    Lines are compared without blanks at their ends; blank lines are no symbols and stay.
    ``n_lines`` counts lines that are not blank, ``n_runs`` the deleted stretches, and ``longest_run``
    is the exact greatest number of lines in a row that also stand in an earlier place, deleted
    or not. A null text stays null and has no lines. Rows equal in id and text are one
    document and treated alike; null ids come first in order. An empty table gives none.
    """
    return _without(docs, _cuts(docs, min_lines, min_words, id_col, text_col), id_col, text_col)


def _without(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every row of ``docs`` without the lines that ``found`` flags, with its counts."""
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("version", _version())
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version"))
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.coalesce(F.try_element_at("gone", i + 1), F.lit(False)))
    return rows.join(found, same, "left").select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(_solid_lines()).alias("n_lines"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_removed", "n_runs", "longest_run")],
    )


def remove_repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the later copies that ``dedup_runs`` deletes, ``n_chars`` counted anew.
    Documents that lose their last line go; all others, empty ones too, stay."""
    found = _cuts(docs, min_lines, min_words, "doc_id", "text")
    same = F.col("_d.doc_id").eqNullSafe(F.col("_f._doc")) & (F.xxhash64("_d.text") == F.col("_f._version"))
    joined = docs.alias("_d").join(found.alias("_f"), same, "left")
    kept = F.filter(F.split("_d.text", "\n"), lambda x, i: ~F.coalesce(F.try_element_at("_f.gone", i + 1), F.lit(False)))
    text = F.when(F.col("_f.gone").isNull(), F.col("_d.text")).otherwise(F.array_join(kept, "\n"))
    rows = joined.select(F.struct("_d.*").alias("row"), text.alias("text"), F.col("_f.gone").isNotNull().alias("cut"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    left = rows.where(~F.col("cut") | (F.btrim("text", F.lit(" \t\r\n")) != ""))
    return left.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
