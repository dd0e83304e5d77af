"""Personal data: strict patterns, wider candidates, and boosted trees that choose among them.

*Base spans* are the leftmost non-overlapping matches of one strict pattern per kind that pass
its check; they always count.  *Candidates* come from wider patterns per kind (spelt-out
addresses, other separators, numbers without prefix); they overlap freely, within a kind and
between kinds.  Boosted trees score every candidate by its format and context, without what the
checks test alone (the plus sign, the checksum, the range of the parts).

A candidate is *valid* if it passes the check of its kind once its separators, ``[at]`` and
``[dot]`` are made plain; what fails it, such as a number with a wrong checksum, is never added.
*Evidence* labels the candidates: one is evident if it overlaps a base span of its kind, or is
valid and is grouped as such numbers are or stands after a word that names them.  Evidence does
not gate: the trees learn it, and select by their score alone.  In half of the rows learnt from the
words around the candidate are hidden, so that the form must do; a valid candidate without
evidence is added if its form speaks for it, and an evident one is refused if its form is mostly
that of wrong ones.

The *threshold* of a kind is set on texts kept out of training: the lowest score, ``EVEN`` at
least, from which on ``PRECISION`` of the candidates, without those of strict form, are evident.
One right candidate is put on top beforehand, so the same rule holds at every count: what is wrong
raises the threshold, what is right lowers it, and a threshold above 1 adds nothing.  A failed
candidate counts for as many wrong ones as pass the check by ``CHANCE`` for each that fails.  A
kind without right ones there takes the threshold of all kinds together.

All of it is DataFrame functions and Spark's own tree learner.  Texts are read once; what is
stored and shuffled afterwards are spans.  Spans and scores depend on the text alone, so they are
grouped by a hash of the text, and copies of a text share one row.  The trees learn from at most
``SAMPLE`` candidates; thresholds are set by counts over all candidates kept out.

Positions count code points, the end is exclusive.  Patterns are written so that Java's matcher
neither recurses nor starts again inside a run, whatever the length of a text.  Defined results:
a NULL or empty text has no spans.  Rows may repeat and may lack an id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.store import stored

KINDS = ("email", "ip", "card", "phone")

#: strict patterns; possessive forms of the plain ones, equal in what they match
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: wider patterns
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]++"
             r"(?:(?:\.|\x20\.\x20|\x20?(?:\[dot\]|\(dot\))\x20?)[A-Za-z0-9-]++){0,8}+",
    "ip": r"(?<![0-9])[0-9]{1,5}+(?:\x20?[.,]\x20?[0-9]{1,5}+){3}+",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]{0,2}+[0-9]){11,22}+(?![0-9])",
    "phone": r"(?<![0-9])[+(]?[0-9][0-9\x20()./-]{5,26}[0-9](?![0-9])",
}
#: what a text must hold at all to be searched for a kind
HINTS = {
    "email": r"@|[\[(]at[\])]", "ip": r"[0-9]\x20?[.,]\x20?[0-9]",
    "card": r"[0-9][0-9\x20./-]{9}", "phone": r"[0-9][0-9\x20()./-]{4}",
}
STRICT_HINTS = {
    "email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][0-9\x20-]{11}", "phone": r"\+[0-9]",
}
#: words before a candidate that speak for a kind
NEARBY = {
    "email": r"(?i)mail|contact|kontakt|correo|courriel|write",
    "ip": r"(?i)\bip\b|host|server|addr",
    "card": r"(?i)card|karte|carte|tarjeta|visa|credit|pay",
    "phone": r"(?i)tel|phone|fon|call|fax|mobil|m[oó]vil",
}

#: words right before a candidate that name its kind
NAMED = {
    kind: rf"(?i)(?<!\p{{L}})(?:{words})\P{{L}}{{0,3}}"
          r"(?:(?:at|is|us|me|no|on|to|nr|number)\P{L}{0,3})?$"
    for kind, words in {
        "ip": "ip|ips|host|server|addr|address|adresse",
        "card": "card|cards|karte|kreditkarte|carte|tarjeta|visa|mastercard|amex",
        "phone": "tel|telephone|telefon|teléfono|telefono|téléphone|phone|call|fax|cell|mobile?|"
                 "m[oó]vil",
    }.items()}
#: how numbers of a kind are grouped when no word names them
GROUPED = {
    "card": r"^[0-9]{4}([\x20./-]{1,2})[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(\1[0-9]{1,3})?$|"
            r"^[0-9]{4}([\x20./-]{1,2})[0-9]{6}\3[0-9]{4,5}$",
    "phone": r"^(1[\x20.-]?)?(\([0-9]{3}\)[\x20.-]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}$|"
             r"^00[\x20.-]?[1-9][0-9]{0,2}[\x20./-].*$",
}
#: numbers that pass a check by chance for each one that fails it; 1 where that is not known
CHANCE = {"email": 1.0, "ip": 1.0, "card": 1 / 9, "phone": 1.0}

SAMPLE, PRECISION, EVEN, BINS = 20_000, 0.98, 0.5, 500
#: beginnings of the names of features that are words around a candidate
AROUND = ("near_", "named_")
ROUNDS, DEPTH = 12, 4
CUT = 64
SPAN = "array<struct<kind:int,start:int,end:int>>"


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def _running(values: Column) -> Column:
    """Sum of all values before each place, in steps of ``CUT`` to stay linear."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CUT).cast("int")),
                         lambda c: _sum(F.slice(values, c * CUT + 1, F.lit(CUT))))

    def place(starts: Column) -> Column:
        return F.transform(values, lambda _, i: starts[F.floor(i / CUT).cast("int")] + _sum(
            F.slice(values, F.floor(i / CUT).cast("int") * CUT + 1, i % CUT)))

    def starts(sums: Column) -> Column:
        return F.transform(sums, lambda _, c: _sum(F.slice(sums, F.lit(1), c)))

    return _bind(_bind(blocks, starts), place)


def matches(text: Column, pattern: str, hint: str) -> Column:
    """All matches of a pattern: ``start``, ``end`` (exclusive) and ``found``.

    The texts between the matches and the matches themselves, in turn, make up the text; running
    sums of their lengths are the places.
    """
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    both = F.struct(F.split(text, pattern, -1).alias("rest"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def placed(b: Column) -> Column:
        lengths = F.transform(b["found"], lambda m, i: F.length(b["rest"][i]) + F.length(m))
        return F.when(F.size(b["found"]) == 0, none).otherwise(_bind(
            _running(lengths), lambda before: F.transform(b["found"], lambda m, i: F.struct(
                (before[i] + F.length(b["rest"][i])).cast("int").alias("start"),
                (before[i] + F.length(b["rest"][i]) + F.length(m)).cast("int").alias("end"),
                m.alias("found")))))

    return F.when(text.rlike(hint), _bind(both, placed)).otherwise(none)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the checksum of a card number fits."""
    figures = F.reverse(F.split(digits, ""))

    def value(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        folded = twice - F.when(twice > 9, 9).otherwise(0)
        return F.when(i % 2 == 0, d.cast("int")).otherwise(folded)

    return _sum(F.transform(figures, value)) % 10 == 0


def _passes(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda part: _bind(
            F.regexp_replace(part, "^0+", ""),
            lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)))
    low, high = (13, 19) if kind == "card" else (9, 15)

    def counted(d: Column) -> Column:
        fits = F.length(d).between(low, high)
        return F.when(fits, _luhn(d)).otherwise(False) if kind == "card" else fits

    return _bind(_digits(found), counted)


def _valid(kind: str, found: Column) -> Column:
    """Whether a candidate passes the check of its kind with plain separators."""
    if kind == "email":
        plain = F.regexp_replace(found, r"\x20?(?:\[at\]|\(at\)|@)\x20?", "@")
        plain = F.regexp_replace(plain, r"\x20?(?:\[dot\]|\(dot\)|\.)\x20?", ".")
        return plain.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}$")
    if kind == "ip":
        return _passes(kind, F.regexp_replace(F.regexp_replace(found, r"\x20", ""), ",", "."))
    if kind == "phone":
        return _passes(kind, found) & ~found.rlike(r"^\+|^[0-9]{1,5}(\.[0-9]{1,5}){3}$")
    return _passes(kind, found)


def _backed(kind: str, found: Column, left: Column) -> Column:
    """Whether a valid candidate's grouping or the word before it speaks for its kind."""
    if kind == "email":
        return F.lit(True)
    named = left.rlike(NAMED[kind])
    return named | found.rlike(GROUPED[kind]) if kind in GROUPED else named


def _strict(n: int, kind: str, text: Column) -> Column:
    passing = F.filter(matches(text, STRICT[kind], STRICT_HINTS[kind]),
                       lambda m: _passes(kind, m["found"]))
    return F.transform(passing, lambda m: F.struct(
        F.lit(n).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def _wide(n: int, kind: str, text: Column) -> Column:
    return F.transform(matches(text, WIDE[kind], HINTS[kind]), lambda m: F.struct(
        F.lit(n).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
        m["found"].alias("found"),
        F.substring(text, F.greatest(m["start"] - 23, F.lit(1)), F.least(m["start"], F.lit(24)))
        .alias("left"),
        F.substring(text, m["end"] + 1, F.lit(8)).alias("right")))


def base_spans(text: Column) -> Column:
    """Strict matches that pass, by kind, then place."""
    return F.concat(*[_strict(n, kind, text) for n, kind in enumerate(KINDS)])


def candidates(text: Column) -> Column:
    """Wide matches of every kind with the characters around them."""
    return F.concat(*[_wide(n, kind, text) for n, kind in enumerate(KINDS)])


def _features() -> dict[str, Column]:
    """Format and context of a candidate."""
    found = F.regexp_replace("found", r"^\+", "")
    left, right = F.col("left"), F.col("right")
    digits = _digits(found)
    groups = F.filter(F.split(found, "[^0-9A-Za-z]+"), lambda g: g != "")
    sizes = F.transform(groups, F.length)

    def count(pattern: str, of: Column = found) -> Column:
        return F.regexp_count(of, F.lit(pattern))

    near = {f"near_{kind}": left.rlike(pattern) for kind, pattern in NEARBY.items()}
    near |= {f"named_{kind}": left.rlike(pattern) for kind, pattern in NAMED.items()}
    plain = {
        "kind_of": F.col("kind"), "size": F.length(found), "digits": F.length(digits),
        "letters": count("[A-Za-z]"), "groups": F.size(groups),
        "longest": F.coalesce(F.array_max(sizes), F.lit(0)),
        "shortest": F.coalesce(F.array_min(sizes), F.lit(0)),
        "last": F.coalesce(F.try_element_at(sizes, F.lit(-1)), F.lit(0)),
        "variety": F.size(F.array_distinct(F.split(digits, ""))),
        "dots": count(r"\."), "dashes": count("-"), "blanks": count(r"\x20"),
        "brackets": count(r"[()\[\]]"), "commas": count(","), "slashes": count("/"),
        "at_signs": count("@"), "leading_zero": digits.rlike("^0"),
        "after_letter": left.rlike(r"\p{L}$"), "after_digit": left.rlike(r"[0-9][^\p{L}]?$"),
        "after_break": left.rlike(r"(^|\n)$"), "after_colon": left.rlike(r":\x20?$"),
        "before_letter": right.rlike(r"^\p{L}"), "before_digit": right.rlike(r"^[^\p{L}]?[0-9]"),
        "before_end": right.rlike(r"^($|\n)"), "before_stop": right.rlike(r"^[.,;]"),
    }
    return {name: value.cast("double") for name, value in (plain | near).items()}


@dataclass
class Found:
    """Stored results of one reading of the texts."""

    spans: DataFrame  # version, base
    wide: DataFrame  # version, kind, start, end, positive, valid, evident, formal, features


def read_texts(docs: DataFrame, text: str = "text") -> Found:
    body = F.col(f"`{text}`").cast("string")
    read = stored(
        docs.select(F.xxhash64(body).alias("version"), F.coalesce(body, F.lit("")).alias("body"))
        .select("version", base_spans(F.col("body")).cast(SPAN).alias("base"),
                candidates(F.col("body")).alias("wide"))
        .where("size(base) > 0 OR size(wide) > 0"), "personal-spans")
    overlaps = F.exists("base", lambda b: (b["kind"] == F.col("c.kind"))
                        & (b["start"] < F.col("c.end")) & (b["end"] > F.col("c.start")))
    wide = (
        read.select("version", "base", F.explode("wide").alias("c"))
        .select("version", "c.*", overlaps.alias("positive"))
        .dropDuplicates(["version", "kind", "start", "end"]))
    features = _features()
    valid, backed, formal = F.lit(False), F.lit(False), F.lit(False)
    for n, kind in enumerate(KINDS):
        own = F.col("kind") == n
        valid = valid | (own & _valid(kind, F.col("found")))
        backed = backed | (own & _backed(kind, F.col("found"), F.col("left")))
        formal = formal | (own & F.col("found").rlike(f"^(?:{STRICT[kind]})$"))
    evident = F.col("positive") | (valid & backed)
    wide = wide.select("version", "kind", "start", "end", "positive", valid.alias("valid"),
                       evident.alias("evident"), (F.col("positive") | formal).alias("formal"),
                       *[value.alias(name) for name, value in features.items()])
    return Found(read.select("version", "base"), stored(wide, "personal-candidates"))


def scored(wide: DataFrame) -> DataFrame:
    """Candidates with the trees' ``score``; ``kept_out`` marks the texts not learnt from.  If all
    that is learnt from has one label, that label is every score."""
    names = list(_features())
    hidden = F.pmod(F.xxhash64("start", "version", "kind", "end"), F.lit(2)) == 0
    marked = wide.withColumns({"kept_out": F.pmod(F.col("version"), F.lit(4)) == 0,
                               "label": F.col("evident").cast("double")})
    learnt = (
        marked.where("NOT kept_out")
        .orderBy(F.xxhash64("version", "kind", "start", "end"), "version", "kind", "start", "end")
        .limit(SAMPLE))
    learnt = learnt.withColumns({name: F.when(hidden, 0.0).otherwise(F.col(name))
                                 for name in names if name.startswith(AROUND)})
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(
        stored(learnt, "personal-sample").repartition(2)).select("features", "label")
    kept = ("version", "kind", "start", "end", "positive", "valid", "evident", "formal", "kept_out")
    labels = [r["label"] for r in rows.select("label").distinct().collect()]  # two at most
    if len(labels) < 2:
        return marked.select(*kept, F.lit(max(labels, default=1.0)).alias("score"))
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, seed=7, stepSize=0.3).fit(rows)
    judged = model.transform(
        VectorAssembler(inputCols=names, outputCol="features").transform(marked))
    return judged.select(*kept, vector_to_array("probability")[1].alias("score"))


def thresholds(judged: DataFrame) -> dict[int, float]:
    """Per kind the lowest score, ``EVEN`` at least, from which on enough of the kept-out
    candidates are right; above 1 if there is none."""
    counts = (
        judged.where("kept_out AND NOT formal")
        .groupBy("kind", F.floor(F.col("score") * BINS).cast("int").alias("bin"))
        .agg(F.count_if("evident").alias("right"),
             F.count_if(~F.col("evident") & F.col("valid")).alias("wrong"),
             F.count_if(~F.col("evident") & ~F.col("valid")).alias("failed"))
        .collect())  # at most kinds times bins rows
    return thresholds_of([tuple(r) for r in counts])


def thresholds_of(counts: list[tuple[int, int, int, int, int]]) -> dict[int, float]:
    """Thresholds from kind, bin, and the numbers of right, wrong and failed candidates."""
    def least(rows: list) -> float:
        right, wrong, out = 1.0, 0.0, 2.0
        bins = {row[1] for row in rows if row[1] >= EVEN * BINS} | {int(EVEN * BINS)}
        for bin_ in sorted(bins, reverse=True):
            for kind, _, more, bad, failed in (row for row in rows if row[1] == bin_):
                right += more
                wrong += bad + CHANCE[KINDS[kind]] * failed
            if right >= PRECISION * (right + wrong):
                out = bin_ / BINS
        return out

    own = {kind: [row for row in counts if row[0] == kind] for kind in range(len(KINDS))}
    return {kind: least(rows if any(row[2] for row in rows) else counts)
            for kind, rows in own.items()}


def find(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per input row: ``doc_id``, ``base`` and ``spans`` (kind, start, end; ``spans`` holds the
    base spans and the added ones), and ``added``, their number."""
    found = read_texts(docs, text)
    judged = scored(found.wide)
    chosen = F.lit(False)
    for kind, least in thresholds(judged).items():
        chosen = chosen | ((F.col("kind") == kind) & (F.col("score") >= least))
    added = judged.where("valid AND NOT positive").where(chosen).groupBy("version").agg(
        F.collect_set(F.struct("kind", "start", "end")).alias("more"))
    base = found.spans.dropDuplicates(["version"]).select("version", "base")
    all_spans = stored(base.join(added, "version", "left"), "personal-result")
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.xxhash64(body).alias("version"))
    none = F.array().cast(SPAN)
    return rows.join(all_spans, "version", "left").select(
        "doc_id", "version", F.coalesce("base", none).alias("base"),
        F.array_sort(F.concat(F.coalesce("base", none), F.coalesce(F.col("more").cast(SPAN), none)))
        .alias("spans"), F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("added"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by its kind in brackets."""
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def pieces(s: Column) -> Column:
        reach = F.transform(s, lambda _, i: F.coalesce(F.array_max(F.transform(
            F.slice(s, F.lit(1), i), lambda x: x["end"])), F.lit(0)))
        return _bind(reach, lambda r: F.concat(
            F.array_join(F.transform(s, lambda x, i: F.when(x["start"] < r[i], "").otherwise(
                F.concat(F.substring(text, r[i] + 1, x["start"] - r[i]),
                         F.lit("["), names[x["kind"]], F.lit("]")))), ""),
            F.substring(text, F.array_max(F.transform(s, lambda x: x["end"])) + 1, F.length(text))))

    return F.when(F.size(spans) == 0, text).otherwise(_bind(ordered, pieces))


def digest(found: DataFrame) -> DataFrame:
    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"), F.col("added").alias("n_added"))


def brute_force(text: str | None) -> list[str]:
    """Base spans by Python's matcher; for tests."""
    import re

    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
             "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, pattern in plain.items():
        for m in re.finditer(pattern, text or ""):
            d = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and sum(
                    x if k % 2 == 0 else x * 2 - 9 * (x > 4)
                    for k, x in enumerate(reversed(d))) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
