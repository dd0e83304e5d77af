"""Keep the earliest of equal and nearly equal lines, with DataFrame functions only.

Two lines are near if one turns into the other by inserting, deleting or replacing at most one
word.  Lines are what line feeds separate, words what single spaces separate.  A line is removed
if an equal or near line stands earlier, by document id, then by line number.  Blank lines stay,
and lines of fewer than ``MIN_WORDS`` words are compared for equality only.

*Deletion neighbourhood.*  Deleting the word at place ``i`` of a line gives a variant.  Two lines
of the same length differ in at most the word at ``i`` if their variants at ``i`` are equal; a
line becomes a shorter one by deleting a word if the variant is that line.  Variants are hashed
keys: place, length and hash for replacements, the hash alone for deletions.  Under every key
only the earliest holder is kept (and, for deletions, the earliest holder of either kind), a
minimum that combines map-side; so no pairs are made and a key may have any number of lines.

*Which lines are varied.*  Near lines agree in the first or the last half of their words. Every
line gives the hashes of its halves, once by its own length and once as the longer of two lines.
Only lines that share one with a different line are varied, and only at the places and in the
role that the shared half leaves open.  Nothing is lost by that.  The earliest near line found is
verified: removing the word at the named place must leave exactly the same words on both sides.

Hashes of variants combine by exclusive or, so that a line of ``n`` words costs ``n`` steps.

Defined results: a NULL text has no lines and stays NULL.  Rows without an id take no part and
keep their lines.  Rows that share an id are told apart by their text; equal rows are earlier or
later nowhere, so all of them keep or lose the same lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroute.llm.store import stored

#: shorter lines are compared for equality only
MIN_WORDS = 5

LINE = ("hash", "check", "n")


def _named(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    body = F.col(f"`{text}`").cast("string")
    return docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                       F.xxhash64(body).alias("version"), body.alias("text"))


#: whether line number ``k`` is marked in ``__marks``, which has a number of 64 bits for 64 lines
_MARKED = "coalesce(getbit(get(__marks, CAST(k div 64 AS INT)), CAST(k % 64 AS INT)) = 1, false)"


def _marked(places: DataFrame) -> DataFrame:
    """Line numbers per text as ``__marks``, bits in an array, with their count ``__n``: whether a line
    is marked is then told at once, however many lines a text has."""
    bits = places.groupBy("doc_id", "version", F.expr("CAST(line div 64 AS INT)").alias("part")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(line % 64 AS INT))")).alias("bits"))
    held = bits.groupBy("doc_id", "version").agg(
        F.map_from_entries(F.collect_list(F.struct("part", "bits"))).alias("held"),
        F.max("part").alias("last"), F.sum(F.bit_count("bits")).alias("__n"))
    return held.select("doc_id", "version", F.transform(
        F.sequence(F.lit(0), "last"),
        lambda part: F.coalesce(F.try_element_at("held", part), F.lit(0).cast("long")))
        .alias("__marks"), "__n")


def _half_keys(words: Column, n: Column) -> Column:
    """Hashes of the first and last half, as a line of ``n`` words and as one a word longer."""
    def keys(length: Column) -> list[Column]:
        half = F.floor(length / 2).cast("int")
        return [F.xxhash64(F.lit(0), length, F.slice(words, F.lit(1), half)),
                F.xxhash64(F.lit(1), length,
                           F.slice(words, n - (length - half) + 1, length - half))]
    return F.when(n >= MIN_WORDS, F.array(*keys(n), *keys(n - 1)))


def line_table(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """Every line that is not blank, with its place, identity and half keys."""
    lines = _named(docs, id_column, text).where("doc_id IS NOT NULL").select(
        "doc_id", "version", F.posexplode(F.split("text", "\n", -1)).alias("line", "body"))
    words = lines.where(F.trim("body") != "").withColumn("words", F.split("body", " ", -1))
    n = F.size("words")
    return words.select(
        F.struct("doc_id", "version", "line").alias("place"),
        F.xxhash64("body").alias("hash"), F.hash("body", F.lit(7)).alias("check"), n.alias("n"),
        _half_keys(F.col("words"), n).alias("halves"))


def _candidates(distinct: DataFrame) -> DataFrame:
    """Hashes of the lines that share a half with a different line; ``agree`` has a bit for each
    such half: first and last half by the own length, first and last half as the longer line."""
    halves = distinct.where("halves IS NOT NULL").select(
        "hash", F.posexplode("halves").alias("which", "half"))
    # stored, so that both sides of the join come from exchanges and a hot half can be split
    shared = stored(
        halves.groupBy("half").agg(F.min("hash").alias("one"), F.max("hash").alias("other"))
        .where("one <> other").select("half"), "shared-halves")
    return halves.join(shared, "half").groupBy("hash").agg(
        F.bit_or(F.expr("shiftleft(1, which)")).alias("agree"))


def _agrees(bit: int) -> Column:
    return F.col("agree").bitwiseAND(F.lit(bit)) != 0


def _word_hashes(varied: DataFrame) -> DataFrame:
    """One row per word of the varied lines: the line's hash without that word, once with the
    words after it left in place (``replaced``) and once moved up (``deleted``)."""
    words = varied.select(*LINE, "agree", F.posexplode("words").alias("i", "word"))
    words = words.withColumns({"here": F.xxhash64("i", "word"),
                               "moved": F.xxhash64(F.col("i") - 1, F.col("word"))})
    before = Window.partitionBy(*LINE).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*LINE)
    shift = F.col("here").bitwiseXOR(F.col("moved"))
    return (
        words.withColumns({
            "all": F.bit_xor("here").over(whole), "all_moved": F.bit_xor("moved").over(whole),
            "shifted": F.coalesce(F.bit_xor(shift).over(before), F.lit(0).cast("long"))})
        .select(*LINE, "agree", "i", "all",
                F.col("all").bitwiseXOR(F.col("here")).alias("replaced"),
                F.col("all_moved").bitwiseXOR(F.col("shifted")).bitwiseXOR(F.col("moved"))
                .alias("deleted")))


def _keys(varied: DataFrame) -> DataFrame:
    """Hashed variants of the varied lines: without the word at ``i`` in place (kind 0), with a
    word deleted (kind 1), and the whole line (kind 2, ``i`` is -1)."""
    i, n = F.col("i"), F.col("n")
    own, longer = F.floor(n / 2), F.floor((n - 1) / 2)
    replaced = (_agrees(1) & (i >= own)) | (_agrees(2) & (i < own))
    deleted = (_agrees(4) & (i >= longer)) | (_agrees(8) & (i <= longer))
    whole = (i == 0) & (_agrees(1) | _agrees(2))

    def key(wanted: Column, kind: int, value: Column, place: Column) -> Column:
        return F.when(wanted, F.struct(value.alias("key"), F.lit(kind).alias("kind"),
                                       place.cast("int").alias("i")))

    each = F.array_compact(F.array(
        key(replaced, 0, F.xxhash64(F.lit("r"), "i", "n", "replaced"), i),
        key(deleted, 1, F.xxhash64(F.lit("d"), n - 1, F.col("deleted")), i),
        key(whole, 2, F.xxhash64(F.lit("d"), n, F.col("all")), F.lit(-1))))
    return _word_hashes(varied).select(*LINE, F.explode(each).alias("one")).select("one.*", *LINE)


def _near(varied: DataFrame) -> DataFrame:
    """Per varied line: the earliest near line found, and the places of the word that differs
    (-1 where the line has no such word)."""
    keys = stored(_keys(varied), "line-variants")
    common = stored(
        keys.groupBy("key").agg(F.min("hash").alias("one"), F.max("hash").alias("other"))
        .where("one <> other").select("key"), "common-variants")
    shared = stored(
        keys.join(common, "key").join(varied.select(*LINE, "place"), list(LINE)), "shared-variants")
    entry = F.struct("place", *LINE, "i")
    earliest = stored(
        shared.groupBy("key").agg(
            F.min(F.when(F.col("kind") == 0, entry)).alias("replaced"),
            F.min(F.when(F.col("kind") == 1, entry)).alias("deleted"),
            F.min(F.when(F.col("kind") == 2, entry)).alias("whole")), "earliest-variants")
    other = (F.when(F.col("kind") == 0, F.col("replaced"))
             .when(F.col("kind") == 1, F.col("whole")).otherwise(F.col("deleted")))
    met = shared.join(earliest, "key").withColumn("other", other).where("other.place < place")
    return met.groupBy(*LINE, "place").agg(
        F.min(F.struct("other", "i")).alias("found")).select(
        *LINE, "place", F.col("found.i").alias("i"), F.col("found.other").alias("other"))


def _without(words: Column, i: Column) -> Column:
    """Words without the one at ``i`` (all, if ``i`` is -1)."""
    return F.when(i < 0, words).otherwise(F.concat(
        F.slice(words, F.lit(1), F.greatest(i, F.lit(0))),
        F.slice(words, i + 2, F.greatest(F.size(words) - i - 1, F.lit(0)))))


def _verified(near: DataFrame, varied: DataFrame) -> DataFrame:
    """Lines whose earliest near line really differs in the named word at most."""
    texts = varied.select(*LINE, "words")
    others = texts.select(*[F.col(name).alias(f"o_{name}") for name in LINE],
                          F.col("words").alias("o_words"))
    both = near.select(*LINE, "place", "i", *[F.col(f"other.{name}").alias(f"o_{name}")
                                              for name in (*LINE, "i")])
    both = both.join(texts, list(LINE)).join(others, [f"o_{name}" for name in LINE])
    same = _without(F.col("words"), F.col("i")) == _without(F.col("o_words"), F.col("o_i"))
    return both.where(same).select("place")


def removed_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``version`` and the marks and number of the removed lines, of the texts that
    lose lines."""
    lines = stored(line_table(docs, id_column, text), "lines")
    first = stored(
        lines.groupBy(*LINE).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("copies"),
                                 F.first("halves").alias("halves")), "distinct-lines")
    asked = stored(first.join(_candidates(first), "hash").select(
        *LINE, "agree", "first.doc_id", "first.version", "first.line"), "asked-lines")
    # every text is cut into lines once, and only the asked ones travel
    texts = _named(docs, id_column, text).dropDuplicates(["doc_id", "version"]).join(
        _marked(asked), ["doc_id", "version"])
    bodies = texts.select(
        "doc_id", "version", "__marks", F.posexplode(F.split("text", "\n", -1)).alias("k", "body")
    ).where(_MARKED).select("doc_id", "version", F.col("k").alias("line"), "body")
    varied = stored(
        asked.join(bodies, ["doc_id", "version", "line"]).select(
            *LINE, "agree", F.struct("doc_id", "version", "line").alias("place"),
            F.split("body", " ", -1).alias("words")), "varied-lines")
    later = _verified(_near(varied), varied)
    copies = first.where("copies > 1").select(*LINE, "first")
    gone = (
        lines.join(copies, list(LINE)).where("place > first").select("place")
        .union(later))
    return _marked(gone.select("place.doc_id", "place.version", "place.line"))


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                added: tuple[str, str] = ("lines_read", "lines_gone")) -> DataFrame:
    """All rows and columns of ``docs``; ``text`` without its removed lines, and two columns named
    by ``added``: the number of lines before and of lines removed.  Columns of ``docs`` with
    these names are replaced."""
    gone = removed_lines(docs, id_column, text).select(
        F.col("doc_id").alias("__doc"), F.col("version").alias("__version"), "__marks", "__n")
    body = F.col(f"`{text}`").cast("string")
    joined = docs.withColumn("__body", body).join(
        gone, (F.col(f"`{id_column}`").cast("long") == F.col("__doc"))
        & (F.xxhash64("__body") == F.col("__version")), "left")
    kept = F.expr(f"array_join(filter(split(__body, '\n', -1), (x, k) -> NOT {_MARKED}), '\n')")
    columns = [F.when(F.col("__n").isNull(), F.col("__body")).otherwise(kept).alias(name)
               if name == text else F.col(f"`{name}`") for name in docs.columns
               if name not in added]
    return joined.select(
        *columns,
        F.when(F.col("__body").isNull(), 0).otherwise(F.size(F.split("__body", "\n", -1)))
        .cast("long").alias(added[0]),
        F.coalesce("__n", F.lit(0)).cast("long").alias(added[1]))


def digest(deduped: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    return deduped.select(
        F.col(id_column).alias("doc_id"), F.col("lines_read").alias("n_lines"),
        F.col("lines_gone").alias("n_removed"),
        F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("kept_sha256"))


def brute_force(rows, min_words: int = MIN_WORDS):
    """The same by comparing every pair of lines; for tests."""
    import hashlib

    def near(a: str, b: str) -> bool:
        x, y = a.split(" "), b.split(" ")
        if a == b:
            return True
        if min(len(x), len(y)) < min_words or abs(len(x) - len(y)) > 1:
            return False
        if len(x) == len(y):
            return sum(p != q for p, q in zip(x, y)) <= 1
        if len(x) < len(y):
            x, y = y, x
        return any(x[:k] + x[k + 1:] == y for k in range(len(x)))

    first: dict[str, tuple] = {}
    placed = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    for i, text in placed:
        for k, line in enumerate((text or "").split("\n")):
            first.setdefault(line, (i, k))
    limit = {}
    for a in first:
        if a.strip(" "):
            limit[a] = min(first[b] for b in first if b.strip(" ") and near(a, b))
    out = []
    for i, text in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for k, x in enumerate(lines)
                if i is None or not x.strip(" ") or (i, k) <= limit[x]]
        out.append((i, len(lines), len(lines) - len(kept),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out
