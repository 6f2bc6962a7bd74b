"""Secret scan: a trigram inverted index picks the candidates, regexes verify them.

Each rule's regex is turned into a Boolean query over lower-cased trigrams that
every match must contain, as a disjunction of trigram sets. The index holds one
posting per (trigram, text) for the trigrams that some query names. Postings of
a text are intersected as bits, map-side sums first, so that one short row per
text is shuffled; texts that satisfy a query are candidates of its rule, and
only there the regex runs. Rules whose regex forces no trigram scan every text.

All of it is DataFrame functions: no Python runs on the executors.

Positions are code points. ``split`` by a regex gives the text between its
leftmost non-overlapping matches, ``regexp_extract_all`` the matches, and their
lengths alternate to the positions.

Defined results: null or empty text has no spans; repeated rows give equal rows;
rows with a null id or equal ids are told apart by their text; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SecretRule:
    """``regex`` finds leftmost non-overlapping matches; one counts if its group
    ``group`` (0: all of it) has at least ``min_length`` characters."""

    kind: str
    regex: str
    group: int = 0
    min_length: int = 0
    base: bool = False


#: The base kinds in their order, then the kinds that this scan adds.
RULES = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    SecretRule("hex", r"[0-9a-f]+", 0, 32, True),
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36}"),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    SecretRule("basic_auth", r"://[A-Za-z0-9._-]+:[^@/\x20]{3,}@"),
)

#: A set of alternatives larger than this says nothing.
MOST_STRINGS = 64
MASK_BITS = 62


# --- trigram queries --------------------------------------------------------

Query = frozenset  # of frozensets of trigrams: any set, all of its trigrams


def _either(a: Query, b: Query) -> Query:
    both = a | b
    return frozenset(s for s in both if not any(t < s for t in both))


def _both(a: Query, b: Query) -> Query:
    return reduce(_either, (frozenset([x | y]) for x in a for y in b), frozenset())


ANY: Query = frozenset([frozenset()])


def _of_strings(strings: set[str]) -> Query:
    """What a text must contain that has one of the strings in it."""
    return reduce(_either, (frozenset([frozenset(s[i:i + 3] for i in range(len(s) - 2))]) for s in strings), frozenset())


def _walk(items) -> tuple[set[str] | None, Query]:
    """Of a parsed sequence: the strings it can match (None: too many), lower-cased,
    and a query that each of its matches satisfies."""
    strings: set[str] = {""}
    query, whole = ANY, True
    for op, arg in items:
        found, inner = _node(op, arg)
        if found is not None and len(found) * len(strings) <= MOST_STRINGS:
            strings = {a + b for a, b in product(strings, found)}
            continue
        query, whole = _both(_both(query, _of_strings(strings)), inner if found is None else _of_strings(found)), False
        strings = {""}
    return (strings, query) if whole else (None, _both(query, _of_strings(strings)))


def _node(op, arg) -> tuple[set[str] | None, Query]:
    if op is sre.LITERAL:
        return {chr(arg).lower()}, ANY
    if op is sre.IN:
        if all(k is sre.LITERAL for k, _ in arg) and len(arg) <= 8:
            return {chr(c).lower() for _, c in arg}, ANY
        return None, ANY
    if op is sre.SUBPATTERN:
        return _walk(arg[3])
    if op is sre.BRANCH:
        found, queries = zip(*[_walk(x) for x in arg[1]])
        if all(x is not None for x in found) and sum(map(len, found)) <= MOST_STRINGS:
            return set().union(*found), ANY
        return None, reduce(_either, (q if x is None else _of_strings(x) for x, q in zip(found, queries)), frozenset())
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = arg
        strings, query = _walk(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, ANY
        if (low, high) == (1, 1):
            return strings, query
        return None, (ANY if low == 0 else query if strings is None else _of_strings(strings))
    return None, ANY


def trigram_query(regex: str) -> Query | None:
    """Sets of trigrams of which each match's lower-cased text contains all of at
    least one; None where the regex forces none."""
    strings, query = _walk(sre_parser.parse(regex))
    query = _both(query, _of_strings(strings)) if strings is not None else query
    return None if frozenset() in query or not query else query


# --- index, candidates ------------------------------------------------------

def _key() -> Column:
    """Names a text: rows with one id and different texts, or null ids, differ."""
    return F.xxhash64("id", "text")


def _words(trigrams: list[str]) -> range:
    return range(-(-len(trigrams) // MASK_BITS))


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index of ``(id, text)`` rows: ``(trigram, key)``, the trigram as
    its place in ``trigrams``."""
    lowered = F.lower("text")
    present = F.array(*[F.when(F.contains(lowered, F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)])
    return docs.select(_key().alias("key"), F.explode(F.array_compact(present)).alias("trigram"))


def candidates(index: DataFrame, trigrams: list[str], queries: dict[str, Query]) -> DataFrame:
    """``(key, kind...)``: per text the rules whose query its postings satisfy, as one
    Boolean column per rule; texts that satisfy none are absent."""
    bit = lambda i: 1 << (i % MASK_BITS)
    in_word = lambda w: F.floor(F.col("trigram") / MASK_BITS) == w
    masks = index.groupBy("key").agg(*[
        F.coalesce(F.bit_or(F.when(in_word(w), F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("trigram") % MASK_BITS).cast("int")))),
                   F.lit(0).cast("bigint")).alias(f"mask{w}") for w in _words(trigrams)])
    at = {t: i for i, t in enumerate(trigrams)}

    def holds(query: Query) -> Column:
        def all_of(part: frozenset) -> Column:
            need = [sum(bit(at[t]) for t in part if at[t] // MASK_BITS == w) for w in _words(trigrams)]
            return reduce(lambda a, b: a & b, [F.col(f"mask{w}").bitwiseAND(F.lit(n).cast("bigint")) == F.lit(n).cast("bigint")
                                               for w, n in enumerate(need) if n])
        return reduce(lambda a, b: a | b, [all_of(p) for p in sorted(query, key=sorted)])

    kinds = {kind: holds(q) for kind, q in queries.items()}
    return masks.select("key", *[c.alias(k) for k, c in kinds.items()]).where(reduce(lambda a, b: a | b, [F.col(k) for k in kinds]))


# --- verification -----------------------------------------------------------

SPAN = "struct<start:int,kind:int,end:int>"


def _searched(rule: SecretRule) -> tuple[str, bool]:
    """The regex to run, and whether a match's length must still be tested. In a run
    of one class, too short ones need not be found at all."""
    if rule.group == 0 and rule.min_length and rule.regex.endswith("+"):
        prefix = rule.regex.index("[")
        return f"{rule.regex[:-1]}{{{rule.min_length - prefix},}}", False
    return rule.regex, bool(rule.min_length)


def _spans(rule: SecretRule, place: int) -> Column:
    """The rule's spans in ``text``, as an array of (start, place of the kind, end)."""
    pattern, tested = _searched(rule)
    text, regex = F.col("text"), F.lit(pattern)
    columns = [F.transform(F.split(text, regex, -1), F.length), F.transform(F.regexp_extract_all(text, regex, 0), F.length)]
    columns.append(F.transform(F.regexp_extract_all(text, regex, rule.group), F.length) if tested else columns[1])

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["0"]
        end = start + F.coalesce(x["1"], F.lit(0))
        found = F.array(F.struct(start.alias("start"), F.lit(place).alias("kind"), end.alias("end")))
        taken = x["1"].isNotNull() & ((x["2"] >= rule.min_length) if tested else F.lit(True))
        return F.struct(end.alias("at"), F.when(taken, F.concat(state["spans"], found)).otherwise(state["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    zipped = F.arrays_zip(*[c.alias(str(i)) for i, c in enumerate(columns)])
    return F.aggregate(zipped, zero, step, lambda s: s["spans"])


def scan(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id``, ``text`` (empty for null), ``rest`` (a struct of the other
    columns) and ``found``, all spans by start and then kind as listed:
    array<struct<start, kind (place in ``rules``), end>>."""
    others = [c for c in docs.columns if c != text_col]
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest"))
    queries = {r.kind: q for r in rules if (q := trigram_query(r.regex))}
    none = F.array().cast(f"array<{SPAN}>")
    flagged = docs
    if queries:
        trigrams = sorted({t for q in queries.values() for part in q for t in part})
        chosen = candidates(postings(docs, trigrams), trigrams, queries)
        flagged = docs.withColumn("key", _key()).join(chosen, "key", "left")
    each = [F.when(F.col(r.kind), _spans(r, i)).otherwise(none) if r.kind in queries else _spans(r, i) for i, r in enumerate(rules)]
    return flagged.select("id", "text", "rest", F.array_sort(F.concat(*each)).alias("found"))


def _named(spans: Column, rules: tuple[SecretRule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame, rules: tuple[SecretRule, ...] = RULES, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``scan``: a count per base kind, the hash of the base spans and all spans as text."""
    base = [i for i, r in enumerate(rules) if r.base]
    count = lambda place: F.size(F.filter("found", lambda s: s["kind"] == place)).cast("bigint")
    counts = [count(i).alias(f"n_{rules[i].kind}") for i in base]
    base_spans = F.filter("found", lambda s: s["kind"].isin(base))
    return scanned.select(F.col("id").alias(id_col), *counts, F.sha2(_named(base_spans, rules), 256).alias("base_sha256"),
                          _named(F.col("found"), rules).alias("spans"))


def redact(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, mark: str = "[REDACTED]",
           text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows with each span in their text replaced by ``mark``; spans that overlap
    are replaced as one. Text without spans stays (null becomes empty), and so do
    the other columns."""
    rows, text = scan(docs, rules, id_col, text_col), F.col("text")

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(state["out"], between, F.lit(mark))).otherwise(state["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate("found", zero, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text) - s["at"])))
    clean = F.when(F.size("found") > 0, whole).otherwise(text)
    return rows.select(*[(clean if c == text_col else F.col("rest").getField(c)).alias(c) for c in docs.columns])


def oracle(rules: tuple[SecretRule, ...] = RULES) -> str:
    """The digest of ``documents`` as DuckDB SQL. Letters in either case are written
    out as classes, since that engine folds more than A-Z."""
    def plain(regex: str) -> str:
        folded = "password|passwd|secret|token|api_?key"
        return regex.replace(f"(?i:{folded})", "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in folded)).replace("'", "''")

    found, lists = [], []
    for i, r in enumerate(rules):
        regex, shortest = plain(_searched(r)[0]), r.min_length
        found.append(f"regexp_extract_all(t, '{regex}') as m{i}, regexp_extract_all(t, '{regex}', {r.group}) as g{i}, regexp_split_to_array(t, '{regex}') as b{i}")
        lists.append(f"""list_transform(list_filter(list_transform(range(1, len(m{i}) + 1), lambda j: {{
            's': list_sum(list_transform(list_slice(b{i}, 1, j), lambda x: length(x))) + coalesce(list_sum(list_transform(list_slice(m{i}, 1, j - 1), lambda x: length(x))), 0),
            'e': length(m{i}[j]), 'g': length(g{i}[j])}}), lambda x: x.g >= {shortest}),
            lambda x: {{'s': x.s::bigint, 'k': {i}, 'e': (x.s + x.e)::bigint}})""")
    names = "[" + ", ".join(f"'{r.kind}'" for r in rules) + "]"
    base = ", ".join(str(i) for i, r in enumerate(rules) if r.base)
    text_of = f"lambda x: {names}[x.k + 1] || ':' || x.s || ':' || x.e"
    counts = ", ".join(f"len(list_filter(f, lambda x: x.k = {i}))::bigint as n_{r.kind}" for i, r in enumerate(rules) if r.base)
    return f"""
    with d as materialized (select doc_id, coalesce(text, '') as t from documents),
    m as materialized (select doc_id, {', '.join(found)} from d),
    s as materialized (select doc_id, list_sort(flatten([{', '.join(lists)}])) as f from m)
    select doc_id, {counts},
      sha256(coalesce(array_to_string(list_transform(list_filter(f, lambda x: x.k in ({base})), {text_of}), ','), '')) as base_sha256,
      coalesce(array_to_string(list_transform(f, {text_of}), ','), '') as spans
    from s"""
