"""Secrets, found through a trigram inverted index."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltylens.llm.common import keep, match_spans, span_text, tagged, texts


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, which Java and Python read alike.

    A match counts from ``min_length`` characters on; a part that matches ``head`` at its start is not counted.
    """

    kind: str
    pattern: str
    min_length: int = 0
    head: str = ""
    screen: str = ""  # a cheaper pattern that every text with a valid match holds


# Patterns and lengths of the base kinds.
KEY = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?"
BASE = (
    Rule("assign", KEY + r"[A-Za-z0-9+/_.=-]++", 6, KEY),
    Rule("access", r"AKIA[A-Z0-9]++", 20, screen=r"AKIA[A-Z0-9]{16}"),
    Rule("hex", r"[0-9a-f]++", 24, screen=r"[0-9a-f]{24}"),
)
# Published formats of issued keys.
FORMATS = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}+"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,250}+"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
    Rule("pem", r"-----BEGIN\x20(?:RSA\x20|EC\x20|OPENSSH\x20)?PRIVATE\x20KEY-----"),
)
EXPAND = 64  # longest list of alternatives that is still written out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """A matching text, lower-cased, holds all trigrams of at least one of these sets.

    None if the pattern can match without any trigram: then no list can rule a text out.
    """
    ways = []
    for runs in _alternatives(list(_parser.parse(pattern))):
        grams = frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2))
        if not grams:
            return None
        ways.append(grams)
    return sorted({w for w in ways if not any(v < w for v in ways)}, key=sorted)


GAP = "\0"  # stands for anything between two literal runs


def _alternatives(items: list) -> list[list[str]]:
    """Every way to match, as its runs of literal characters."""
    strings = [""]
    for item in items:
        step = _strings(*item)
        joined = [a + b for a, b in product(strings, step)]
        strings = joined if len(joined) <= EXPAND else [s + GAP for s in strings]
    return [[run for run in s.split(GAP) if run] for s in strings]


def _strings(op, value) -> list[str]:
    if op is sre.LITERAL:
        return [chr(value).lower()]
    if op is sre.IN:
        if all(kind is sre.LITERAL for kind, _ in value) and len(value) <= 5:
            return sorted({chr(code).lower() for _, code in value})
        return [GAP]
    if op is sre.SUBPATTERN:
        return _sequence(value[3])
    if op is sre.BRANCH:
        return [s for branch in value[1] for s in _sequence(branch)]
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        least, most, inner = value
        if (least, most) == (0, 1):
            return ["", *_sequence(inner)]
        once = _sequence(inner)
        return [s + GAP for s in once] if least and len(once) <= 5 else [GAP]
    return [GAP]


def _sequence(items) -> list[str]:
    strings = [""]
    for item in items:
        strings = [a + b for a, b in product(strings, _strings(*item))]
    return strings if len(strings) <= EXPAND else [GAP]


def postings(rows: DataFrame, grams: list[str]) -> DataFrame:
    """The inverted index of the trigrams that any rule asks for: (gram, doc_id, text_hash)."""
    low = rows.select("doc_id", "text_hash", F.lower("text").alias("low"))
    present = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams)))
    return low.select("doc_id", "text_hash", F.explode(present).alias("gram"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(doc_id, text_hash, kinds): documents in all postings of a set of a rule's query.

    The sets are as few and as small as the rules, so they are part of the plan.
    """
    wanted: dict[str, list[Column]] = {}
    for kind, ways in queries.items():
        for n, way in enumerate(ways):
            use = F.struct(F.lit(kind).alias("kind"), F.lit(n).alias("way"), F.lit(len(way)).alias("need"))
            for gram in sorted(way):
                wanted.setdefault(gram, []).append(use)
    uses = reduce(lambda rest, g: F.when(F.col("gram") == g, F.array(*wanted[g])).otherwise(rest), wanted, F.lit(None))
    each = index.select("doc_id", "text_hash", "gram", F.explode(uses).alias("use")).distinct()
    met = each.groupBy("doc_id", "text_hash", "use").count().filter(F.col("count") == F.col("use.need"))
    return met.groupBy("doc_id", "text_hash").agg(F.collect_set("use.kind").alias("kinds"))


def rule_spans(rule: Rule, rank: int) -> Column:
    """Valid matches of the rule in ``text``."""

    def counted(found: Column) -> Column:
        return F.length(F.regexp_replace(found, f"^{rule.head}", "") if rule.head else found)

    spans = match_spans(F.col("text"), rule.pattern, rule.screen)
    if rule.min_length:
        spans = F.filter(spans, lambda s: counted(s["found"]) >= rule.min_length)
    return tagged(spans, rule.kind, rank)


SPANS = "array<struct<rank:int,kind:string,start:bigint,end:bigint>>"


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = (*BASE, *FORMATS)
) -> DataFrame:
    """doc_id and ``found``: an array of (rank, kind, start, end) in code points, by start, then by rank of the rule.

    Rules with mandatory trigrams are only tried on the documents that the index names; the others scan every
    text.  Matches of different kinds may overlap.  A missing text is empty; rows that repeat an id and a text
    come back as often as they are there; a missing id stays missing.
    """
    rows = texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    none = F.array().cast(SPANS)
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    ranked = [(rank, r, queries[r.kind]) for rank, r in enumerate(rules)]
    scanned = [rule_spans(r, rank).cast(SPANS) for rank, r, query in ranked if query is None]
    result = rows.select("doc_id", "text_hash", F.concat(none, *scanned).alias("scanned"))
    indexed = {r.kind: query for _, r, query in ranked if query is not None}
    if indexed:
        grams = sorted({g for ways in indexed.values() for way in ways for g in way})
        named = keep(candidates(postings(rows, grams), indexed))
        tried = [
            F.when(F.array_contains("kinds", r.kind), rule_spans(r, rank).cast(SPANS)).otherwise(none)
            for rank, r, query in ranked if query is not None
        ]
        checked = same_rows(rows, named, "inner").select("doc_id", "text_hash", F.concat(*tried).alias("verified"))
        checked = checked.filter(F.size("verified") > 0).dropDuplicates(["doc_id", "text_hash"])
        result = same_rows(result, checked, "left")
    else:
        result = result.withColumn("verified", none)
    found = F.concat("scanned", F.coalesce("verified", none))
    placed = F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"])))
    in_order = F.transform(placed, lambda s: F.struct(s["rank"], s["kind"], s["start"], s["end"]))
    return result.select("doc_id", in_order.cast(SPANS).alias("found"))


def same_rows(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on doc_id, which may be missing on both sides, and text_hash."""
    other = right.withColumnsRenamed({"doc_id": "other_id", "text_hash": "other_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("text_hash") == F.col("other_hash"))
    return left.join(other, same, how).drop("other_id", "other_hash")


def secrets_report(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base kinds, and all spans."""
    found = find_secrets(docs)
    base = F.filter("found", lambda s: s["rank"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(count(r.kind) for r in BASE),
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"),
    )
