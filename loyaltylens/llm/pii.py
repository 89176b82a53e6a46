"""Personal data: fixed patterns, and further identifiers by bootstrapped contexts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltylens.llm.common import BLANKS, SPACE_CLASS, ascii_lower, keep, match_spans, span_text, tagged, texts, unused


@dataclass(frozen=True)
class Kind:
    """A kind of personal data; ``screen`` is found in every text that has a match.

    A match starts where the run of characters it begins with starts, or where the last match ended, so that a
    long run is read once.
    """

    name: str
    pattern: str
    screen: str


# The base kinds.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]",
    ),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]"),
    Kind("card", r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?+[0-9])++", r"[0-9](?:[\x20-]?+[0-9]){12}"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]"),
)
CONTEXT = "context"
SPANS = "array<struct<rank:int,kind:string,start:bigint,end:bigint>>"

# A token that may be an identifier: at least MIN_DIGITS digits, cut off from brackets, quotes and commas around it.
TOKEN = rf"(?<![^{SPACE_CLASS}])[^{SPACE_CLASS}]*[0-9][^{SPACE_CLASS}]*+"
EDGE = r"[\"'()\[\]{}<>,;:.!?]"
# A token and the groups of digits that spaces, hyphens, dots or brackets join to it.
RUN = rf"{TOKEN}(?:(?<=[0-9)])\x20(?=[0-9(])[0-9().\x20-]*[0-9)](?={EDGE}*+(?:[{SPACE_CLASS}]|\z)))?+"
MIN_DIGITS = 4
TOKEN_SCREEN = rf"[0-9][^{SPACE_CLASS}]*[0-9]"
RUN_SCREEN = rf"{TOKEN_SCREEN}|[0-9]\)?\x20\(?[0-9]"
PATTERN_WORDS = 3  # longest context
REACH = 160  # characters in which the words of a context stand
PATTERNS = "array<struct<left:boolean,gram:bigint>>"
INSTANCE = f"struct<start:bigint,end:bigint,instance:string,patterns:{PATTERNS},seed:boolean>"
BROADCAST_CUES = 1_000_000


def valid(kind: str, found: Column) -> Column:
    """What a match must satisfy beyond its pattern."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        # Leading zeros do not count; a part of more than three digits is too large.
        parts = F.split(found, r"\.")
        value = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").try_cast("int")
        return F.forall(parts, lambda p: F.coalesce(value(p) <= 255, F.lit(False)))
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def luhn(digits: Column) -> Column:
    """Is the Luhn sum a multiple of ten?  From the right, every second digit counts double, less 9 above 9."""
    reverse = F.split(F.reverse(digits), "")

    def part(digit: Column, place: Column) -> Column:
        value = digit.try_cast("int")
        doubled = value * 2
        return F.when(place % 2 == 0, value).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    total = F.aggregate(F.transform(reverse, part), F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0)))
    return total % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans of the base kinds, by kind, then by start."""
    none = F.array().cast(SPANS)
    return F.concat(none, *(tagged(_matches(text, kind), kind.name, n).cast(SPANS) for n, kind in enumerate(KINDS)))


def _matches(text: Column, kind: Kind) -> Column:
    return F.filter(match_spans(text, kind.pattern, kind.screen), lambda s: valid(kind.name, s["found"]))


def gram(words: list[Column]) -> Column:
    """What stands for some words in a row."""
    return F.xxhash64(F.lit(len(words)), *words)


def patterns(text: Column, start: Column, end: Column) -> Column:
    """The one to three words before and after a place, in lower case, as (left, gram).  Brackets and marks at the place
    are no words; there are none where it is not cut off by space."""

    def bound(value: Column, then) -> Column:
        return F.transform(F.array(value), then)[0]

    def grams(side: Column, left: bool) -> Column:
        def pick(words: Column) -> Column:
            size = F.size(words)
            whole = F.when(F.length(side) < REACH, size).otherwise(size - 1)  # the farthest word may be cut
            found = []
            for n in range(1, PATTERN_WORDS + 1):
                own = [F.get(words, size - n + i if left else F.lit(i)) for i in range(n)]
                found.append(F.when((whole >= n) & (words[0] != ""), F.struct(F.lit(left).alias("left"), gram(own).alias("gram"))))
            return F.array_compact(F.array(*found))

        def cut(near: Column) -> Column:
            apart = near.rlike(f"[{SPACE_CLASS}]$" if left else f"^[{SPACE_CLASS}]")
            words = F.split(F.btrim(near, F.lit(BLANKS)), f"[{SPACE_CLASS}]+")
            return F.when(apart, bound(words, pick)).otherwise(F.array().cast(PATTERNS))

        edge = rf"(?<=[{SPACE_CLASS}]){EDGE}++$" if left else rf"^{EDGE}++(?=[{SPACE_CLASS}])"
        return bound(F.regexp_replace(ascii_lower(side), edge, ""), cut)

    first = F.greatest(start - REACH + 1, F.lit(1)).cast("int")
    before = F.substring(text, first, F.least(start, F.lit(REACH)).cast("int"))
    after = F.substring(text, (end + 1).cast("int"), F.lit(REACH))
    return F.concat(grams(before, True), grams(after, False))


def instances(text: Column, base: Column) -> Column:
    """Base spans, as seeds, and runs of digit groups that may be identifiers, with the patterns around each, as
    (start, end, instance, patterns, seed).  Runs that touch a base span are taken apart into tokens; those of them that
    touch it are left out."""

    def place(start: Column, end: Column, found: Column, seed: bool) -> Column:
        return F.struct(start, end, found, patterns(text, start, end), F.lit(seed)).cast(INSTANCE)

    def trimmed(s: Column) -> Column:
        tail = F.regexp_replace(s["found"], f"^{EDGE}++", "")
        core = F.regexp_replace(tail, f"{EDGE}++$", "")
        start = s["start"] + F.length(s["found"]) - F.length(tail)
        return F.struct(start.alias("start"), (start + F.length(core)).alias("end"), core.alias("found"))

    def enough(s: Column) -> Column:
        return F.length(F.regexp_replace(s["found"], "[^0-9]", "")) >= MIN_DIGITS

    def touches(s: Column, others: Column) -> Column:
        return F.exists(others, lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"]))

    def candidates(pattern: str, screen: str) -> Column:
        return F.filter(F.transform(match_spans(text, pattern, screen), trimmed), enough)

    def apart(runs: Column) -> Column:
        broken = F.filter(runs, lambda s: touches(s, base) & s["found"].contains(" "))

        def rest(parts: Column) -> Column:
            own = F.filter(candidates(TOKEN, TOKEN_SCREEN), lambda s: touches(s, parts) & ~touches(s, base))
            return F.when(F.size(parts) > 0, own).otherwise(F.filter(runs, lambda s: F.lit(False)))

        more = F.transform(F.array(broken), rest)[0]
        return F.concat(F.filter(runs, lambda s: ~touches(s, base)), more)

    seeds = F.transform(
        base,
        lambda b: place(b["start"], b["end"], F.substring(text, (b["start"] + 1).cast("int"), (b["end"] - b["start"]).cast("int")), True),
    )
    runs = F.transform(F.array(candidates(RUN, RUN_SCREEN)), apart)[0]
    found = F.transform(runs, lambda s: place(s["start"], s["end"], s["found"], False))
    return F.filter(F.concat(seeds, found), lambda t: F.size(t["patterns"]) > 0)


@dataclass(frozen=True)
class Bootstrap:
    """Settings of the search for further identifiers.

    A cue, one to three words before or after an identifier, is trusted from ``min_seeds`` distinct known identifiers on and if at least ``trust`` of all its
    uses in the corpus are followed by a known one.
    """

    min_seeds: int = 5
    trust: float = 0.5


def cue_counts(rows: DataFrame, cues: DataFrame) -> DataFrame:
    """How often the words of each cue stand in the corpus in a row: (gram, uses)."""
    cut = F.split(F.btrim(ascii_lower("text"), F.lit(BLANKS)), f"[{SPACE_CLASS}]+")
    later = [F.slice("words", n + 1, F.greatest(F.size("words"), F.lit(1))) for n in range(1, PATTERN_WORDS)]
    words = rows.select(cut.alias("words")).select(F.inline(F.arrays_zip("words", *later))).toDF("a", "b", "c")
    grams = words.select(F.explode(F.array(*(gram([F.col(c) for c in "abc"[:n]]) for n in range(1, PATTERN_WORDS + 1)))).alias("gram"))
    wanted = cues.select("gram").distinct()
    if cues.count() <= BROADCAST_CUES:
        # Words of no cue end where they are read.
        return grams.join(F.broadcast(wanted), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("uses"))
    # An inner join stays above the aggregation, so words are added up per task before anything is shuffled.
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("uses")).join(wanted, "gram")


def trusted(occurrences: DataFrame, rows: DataFrame, settings: Bootstrap) -> DataFrame:
    """Occurrences that are no seeds but stand beside a trusted cue: doc_id, text_hash, start, end.

    The graph of cues and instances is scored in rounds until no further cue is trusted.  A cue's score is the share of its uses that known
    instances stand beside; an instance is known if it is a seed or stands beside a trusted cue.  Edges are added up per
    task first, so a cue with a third of all edges is no burden; only edges and scores are shuffled.
    """
    cue = ["left", "gram"]
    every = occurrences.select("*", F.inline("patterns")).drop("patterns")
    edges = keep(every.groupBy(*cue, "instance").agg(
        F.count(F.lit(1)).alias("times"), F.max(F.col("seed").cast("int")).alias("known")
    ))
    # A cue of fewer instances can never have enough seeds.
    wide = edges.groupBy(*cue).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= settings.min_seeds)
    wide = keep(wide.select(*cue))
    uses = keep(cue_counts(rows, wide))
    edges = keep(edges.join(wide, cue, "left_semi"))
    found, size, flagged = None, 0, edges
    while True:
        scores = flagged.groupBy(*cue).agg(
            F.sum("known").alias("seeds"), F.sum(F.col("known") * F.col("times")).alias("hits")
        )
        good = scores.join(uses, "gram").filter(
            (F.col("seeds") >= settings.min_seeds) & (F.col("hits") >= settings.trust * F.col("uses"))
        )
        found, last = keep(good.select(*cue)), size
        size = found.count()
        if size == last:
            break
        # What is known only grows, and all of it follows from the seeds and the cues trusted last.
        learnt = edges.join(found, cue, "left_semi").select("instance").distinct().withColumn("learnt", F.lit(1))
        flagged = edges.join(learnt, "instance", "left").select(
            *cue, "instance", "times", F.greatest("known", F.coalesce("learnt", F.lit(0))).alias("known")
        )
    more = every.filter(~F.col("seed")).join(found, cue, "left_semi")
    return more.select("doc_id", "text_hash", "start", "end")


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Bootstrap = Bootstrap()
) -> DataFrame:
    """doc_id, text_hash and ``found``: an array of (rank, kind, start, end) in code points, by kind, then start.

    The base kinds come from their patterns.  They are the seeds: one to three words that mostly stand
    before or after seeds are cues, and runs of digit groups beside a trusted cue that touch no base span are added as
    ``context``.

    A missing text is empty; rows that repeat an id and a text come back as often as they are there; a missing id
    stays missing.
    """
    rows = texts(docs, id_col, text_col)
    none = F.array().cast(SPANS)
    scanned = rows.withColumn("text_hash", F.xxhash64("text")).withColumn("base", base_spans(F.col("text")))
    scanned = keep(scanned.select("doc_id", "text_hash", "base", instances(F.col("text"), F.col("base")).alias("instances")))
    occurrences = scanned.select("doc_id", "text_hash", F.explode("instances").alias("t")).select(
        "doc_id", "text_hash", "t.*"
    )
    more = trusted(occurrences, rows, settings).distinct()
    rank = len(KINDS)
    spans = more.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("places")
    )
    spans = spans.select(
        F.col("doc_id").alias("other_id"), F.col("text_hash").alias("other_hash"),
        F.transform("places", lambda s: F.struct(
            F.lit(rank).alias("rank"), F.lit(CONTEXT).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
        )).cast(SPANS).alias("added"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("text_hash") == F.col("other_hash"))
    found = F.concat("base", F.coalesce("added", none)).alias("found")
    return scanned.select("doc_id", "text_hash", "base").join(spans, same, "left").select("doc_id", "text_hash", found)


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base kinds, and all spans."""
    found = find_pii(docs)
    base = F.filter("found", lambda s: s["rank"] < len(KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(count(k.name) for k in KINDS),
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets, all columns as they were.

    Spans that overlap are replaced as one, under the kind that starts first.  ``length_col``, if there is such a
    column, gets the new length where the text has changed.
    """
    found = find_pii(docs, id_col, text_col).filter(F.size("found") > 0).dropDuplicates(["doc_id", "text_hash"])
    own_id, own_hash, spans, redacted = (unused(docs, n) for n in ("span_id", "span_hash", "spans", "redacted"))
    found = found.select(
        F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash), F.col("found").alias(spans)
    )
    own = F.coalesce(docs[text_col], F.lit(""))
    same = F.col(id_col).eqNullSafe(F.col(own_id)) & (F.xxhash64(own) == F.col(own_hash))
    joined = docs.join(found, same, "left")
    text = F.col(text_col)

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        mark = F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        inside = s["start"] < acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], gap, mark)).alias("out"),
        )

    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])))
    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    done = F.aggregate(by_start, first, step)
    clean = F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))
    changed = joined.withColumn(redacted, F.when(F.col(spans).isNotNull(), clean).otherwise(text))
    kept = [
        F.col(redacted).alias(c) if c == text_col
        else F.when(F.col(spans).isNotNull(), F.length(redacted)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c)
        if c == length_col else F.col(c)
        for c in docs.columns
    ]
    return changed.select(*kept)
