"""Secret scans over a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: any of some sets of trigrams that every
match contains in lower case.  Documents are indexed by the trigrams that some rule asks for, the postings of each set
are intersected, and only documents in a rule's result are verified by its expression.  A rule without mandatory
trigrams scans every document.  Everything runs on built-in functions.

Only ids move between tasks on the index side; a posting list is never gathered, for intersection counts a set's
trigrams by document.  Of the texts only those move that have the rarest trigram of some set.

Edge cases: a null text is empty and has no spans.  Documents that share an id share their postings, which can only add
candidates; each row is verified by its own text.  A null id is an id like any other.  An empty table gives an empty
result.  Extra columns are ignored, or kept by :func:`redact`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as _c, _parser

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dockside.llm.columns import free_names
from dockside.plans.staging import stage


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``pattern`` has no capturing groups; ``scan`` finds matches the same way, at least as fast."""

    kind: str
    pattern: str
    keep: Callable[[Column], Column] | None = None  # what a match must fulfil besides
    base: bool = False


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""

RULES = (
    Rule(
        "assign", _ASSIGN + "[A-Za-z0-9+/_.=-]+", base=True,
        keep=lambda hit: F.length(F.regexp_extract(hit, f"(?s)^{_ASSIGN}(.*)$", 1)) >= 8,
    ),
    Rule("access", "AKIA[A-Z0-9]{12,}", base=True),  # a run too short has no longer one in it
    Rule("hex", "[0-9a-f]{32,}", base=True),
    Rule("pem", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", "gh[po]_[A-Za-z0-9]{36,}"),
)
#: Alternatives that a query may have before it gives up on what multiplies them.
MAX_ALTERNATIVES = 64
REDACTED = "[REDACTED]"


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Sets of lower-case trigrams: every match has all of some set.  An empty set: nothing is mandatory."""
    out = set()
    for alternative in _alternatives(_parser.parse(pattern)):
        runs = "".join(alternative).split("\0")
        out.add(frozenset(r[k:k + 3] for r in runs for k in range(len(r) - 2)))
    return sorted((s for s in out if not any(o < s for o in out)), key=sorted)


def _alternatives(nodes) -> list[list[str]]:
    """What a match may read, as pieces of literal text; \\0 stands for anything."""
    out: list[list[str]] = [[]]
    for op, arg in nodes:
        if op is _c.LITERAL:
            options = [[chr(arg).lower()]]
        elif op is _c.IN:
            options = _of_set(arg)
        elif op is _c.SUBPATTERN:
            options = _alternatives(arg[-1])
        elif op is _c.BRANCH:
            options = [a for branch in arg[1] for a in _alternatives(branch)]
        elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT, _c.POSSESSIVE_REPEAT):
            least, most, inner = arg
            once = _alternatives(inner)
            if most == 1:
                options = once + ([[]] if least == 0 else [])
            elif least == most <= 8 and len(once) == 1:
                options = [once[0] * least]
            else:
                options = [a + ["\0"] for a in once] if least else [["\0"]]
        elif op is _c.AT:
            options = [[]]
        else:
            options = [["\0"]]
        if len(out) * len(options) > MAX_ALTERNATIVES:
            options = [["\0"]]
        out = [a + b for a in out for b in options]
    return out


def _of_set(members) -> list[list[str]]:
    if any(op is not _c.LITERAL for op, _ in members):
        return [["\0"]]
    chars = sorted({chr(arg).lower() for _, arg in members})
    return [[c] for c in chars] if len(chars) <= 4 else [["\0"]]


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id): the inverted index over those trigrams; one row for each document that has it."""
    low = docs.select("doc_id", F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("low"))
    present = F.array_compact(F.array(*(F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams)))
    return low.select(F.explode(present).alias("trigram"), "doc_id")


def terms_of(queries: dict[str, list[frozenset[str]]]) -> list[str]:
    """The trigrams that the queries ask for."""
    return sorted({t for sets in queries.values() for s in sets for t in s})


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(doc_id, rules): the documents that some rule's query finds in the index, each once with its rules."""
    spark: SparkSession = index.sparkSession
    terms = [(kind, k, t, len(s)) for kind, sets in queries.items() for k, s in enumerate(sets) for t in sorted(s)]
    # As many rows as the rules have trigrams, whatever the corpus.
    asked = F.broadcast(spark.createDataFrame(terms, "rule string, clause int, trigram string, need long"))
    # The postings of a document meet where they were made, so most of the count happens before the shuffle.
    met = index.distinct().join(asked, "trigram").groupBy("doc_id", "rule", "clause").agg(
        F.count("*").alias("n"), F.first("need").alias("need")
    )
    return met.where("n = need").groupBy("doc_id").agg(F.collect_set("rule").alias("rules"))


def rarest(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> list[str]:
    """Of every set the trigram with the shortest posting list: who has none of these is no candidate."""
    length = {r["trigram"]: r["count"] for r in index.groupBy("trigram").count().collect()}
    return sorted({min(sorted(s), key=lambda t: length.get(t, 0)) for sets in queries.values() for s in sets})


def _spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, end, kind>> of the rule's matches, in code points, end exclusive.

    The text is read as stretches of gap and match, the last with an empty match, so lengths give the places.
    """
    stretch = F.lit(f"(?s)(.*?)({rule.pattern}|\\z)")
    keep = rule.keep or (lambda hit: F.lit(True))
    parts = F.arrays_zip(F.regexp_extract_all(text, stretch, 1).alias("gap"), F.regexp_extract_all(text, stretch, 2).alias("hit"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    start = lambda acc, p: acc.at + F.length(p.gap)
    walked = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), none.alias("found")),
        lambda acc, p: F.struct(
            (start(acc, p) + F.length(p.hit)).alias("at"),
            F.when(
                (F.length(p.hit) > 0) & keep(p.hit),
                F.array_append(acc.found, F.struct(start(acc, p).alias("start"), (start(acc, p) + F.length(p.hit)).alias("end"))),
            ).otherwise(acc.found).alias("found"),
        ),
        lambda acc: acc.found,
    )
    return walked


def _ranked(rank: int, kind: str) -> Callable[[Column], Column]:
    return lambda s: F.struct(s.start.alias("start"), F.lit(rank).alias("rank"), s.end.alias("end"), F.lit(kind).alias("kind"))


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda s: s.kind == kind


def find(docs: DataFrame, spans: str = "spans", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with a column ``spans`` of a name it has not: array of (start, rank of the kind, end, kind), ascending."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if all(q)}
    id_, kinds = free_names(docs, "id_", "rules_")
    joined = docs.withColumn(kinds, F.lit(None).cast("array<string>"))
    if indexed:
        index = stage(postings(docs, terms_of(indexed)), "trigram-index")
        found = candidates(index, indexed).select(F.col("doc_id").alias(id_), F.col("rules").alias(kinds))
        # Only texts with a rare trigram move to meet their candidate rules; the rest stay where they are read.
        low = F.lower(F.coalesce(F.col("text"), F.lit("")))
        maybe = F.lit(False)
        for probe in rarest(index, indexed):
            maybe = maybe | low.contains(probe)
        met = docs.where(maybe).join(found.hint("merge"), F.col("doc_id").eqNullSafe(F.col(id_)), "left").drop(id_)
        joined = met.unionByName(joined.where(~maybe))
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    each = []
    for rank, rule in enumerate(rules):
        if rule.kind in indexed:
            verify = F.coalesce(F.array_contains(kinds, rule.kind), F.lit(False))
        else:
            verify = text.rlike(rule.pattern)
        found_here = F.transform(_spans(text, rule), _ranked(rank, rule.kind))
        each.append(F.when(verify, found_here).otherwise(none))
    return joined.withColumn(spans, F.array_sort(F.concat(*each))).drop(kinds)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, mask: str = REDACTED) -> DataFrame:
    """The documents with every span of a secret replaced, touching spans as one; ``n_chars`` follows if it is there."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        own = F.struct(s.start.alias("start"), s.end.alias("end"))
        wider = F.struct(last.start.alias("start"), F.greatest(last.end, s.end).alias("end"))
        touches = (F.size(acc) > 0) & (s.start <= F.try_element_at(acc, F.lit(-1)).end)
        return F.when(touches, F.array_append(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), wider)).otherwise(F.array_append(acc, own))

    spans, clean = free_names(docs, "spans_", "clean_")
    marked = find(docs, spans, rules).withColumn(spans, F.aggregate(spans, none, merge))
    text = F.col("text")
    built = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            s.end.alias("at"), F.concat(acc.out, F.substring(text, acc.at + 1, s.start - acc.at), F.lit(mask)).alias("out")
        ),
        lambda acc: F.concat(acc.out, F.substring(text, acc.at + 1, F.length(text))),
    )
    out = marked.withColumn(clean, F.when(F.size(spans) > 0, built).otherwise(text))
    columns = {"text": F.col(clean)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.size(spans) > 0, F.length(clean).cast(kind)).otherwise(F.col("n_chars"))
    return out.select(*(columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in docs.columns))


def digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts of the base kinds, hash of the base spans, and all spans as text."""
    base = [r.kind for r in rules if r.base]
    found = find(docs.select("doc_id", "text"), "s", rules).select("doc_id", "s")
    of_base = F.filter("s", lambda x: x.kind.isin(base))
    counts = [F.size(F.filter("s", _is(k))).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(spans_text(of_base), 256).alias("base_sha256"), spans_text(F.col("s")).alias("spans"))
