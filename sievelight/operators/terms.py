"""Term matching over lower-cased text: whole tokens and phrases, for literal lists and rule tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from sievelight.functions.text import let, literal_array

TOKEN_PATTERN = "[a-z0-9]+"
_TOKEN = re.compile(TOKEN_PATTERN)
CHANGE_KINDS = ["issue", "merge_request", "pull_request"]  # fixed values


def tokens(low: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(low, F.lit(TOKEN_PATTERN), F.lit(0)))


def is_token_term(term: str) -> bool:
    return term.isalnum()


def term_hits(low: Column, terms) -> Column:
    """Unordered hits of a term universe: one hash intersection for tokens, one search per phrase."""
    words = [t for t in dict.fromkeys(terms) if is_token_term(t)]
    phrases = [t for t in dict.fromkeys(terms) if not is_token_term(t)]
    return F.concat(
        F.array_intersect(literal_array(words), tokens(low)),
        F.filter(literal_array(phrases), lambda p: F.contains(low, p)),
    )


def pick(hits: Column, terms) -> Column:
    """The terms of one list that are among ``hits``, in declaration order; none where ``hits`` is null."""
    terms = list(terms)
    if len(set(terms)) < len(terms):  # an intersection would lose the repeats
        return F.filter(literal_array(terms), lambda t: F.array_contains(hits, t))
    # One hash lookup a term; a lambda would be called, and would search all hits, for every term of every list.
    return F.coalesce(F.array_intersect(literal_array(terms), hits), F.array().cast("array<string>"))


def matched_terms(text: Column, terms) -> Column:
    """Terms that occur in ``text``, in declaration order.

    An alphanumeric term must be a whole ``[a-z0-9]+`` token; any other term matches as a substring.
    """
    # Each step is bound once: a lambda would evaluate it again for every term.
    return let(F.lower(text), lambda low: let(term_hits(low, terms), lambda hits: pick(hits, terms)))


def any_match(hits: Column, terms) -> Column:
    return F.arrays_overlap(hits, literal_array(terms))


def is_change(evidence: Column) -> Column:
    """True when any evidence element is a change event."""
    return F.arrays_overlap(
        F.transform(evidence, lambda e: F.coalesce(e["source_ref"]["kind"], F.lit(""))), literal_array(CHANGE_KINDS)
    )


#: Characters of rule terms that one automaton holds; a larger table is matched in shards of about this size.
SHARD_CHARS = 4_000_000
_AUTOMATA: dict[str, tuple] = {}


def _automaton(name: str, terms: list[str], is_word: list[bool]):
    """Word terms as a lookup, phrases as one automaton with failure links, and the empty phrases; built once per worker."""
    if name not in _AUTOMATA:
        import ahocorasick

        _AUTOMATA.clear()
        words, phrases, empty = {}, ahocorasick.Automaton(), []
        for i, (term, word) in enumerate(zip(terms, is_word)):
            if word:
                words[term] = i
            elif term:
                phrases.add_word(term, i)
            else:
                empty.append(i)
        if len(phrases):
            phrases.make_automaton()
        _AUTOMATA[name] = words, phrases, empty
    return _AUTOMATA[name]


def _hits(low: str, words: dict, phrases, empty: list[int]) -> set[int]:
    found = set(empty)
    if words:
        found.update(words[t] for t in set(_TOKEN.findall(low)) if t in words)
    if len(phrases):
        found.update(i for _, i in phrases.iter(low))
    return found


def _shard_matcher(rules: list, key_type: pa.DataType, entry: pa.DataType, spark: SparkSession):
    """A function over ``(key, lower-cased text)`` batches that returns ``(key, hits)`` of the texts with any."""
    places: dict[tuple[str, bool], list] = {}
    for r in rules:
        places.setdefault((r["term"], r["is_word"]), []).append(r["pos"])
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, [t for t, _ in places], [w for _, w in places], list(places.values())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, terms, is_word, positions = shared.value
        automaton = _automaton(name, terms, is_word)
        for batch in batches:
            rows, hits = [], []
            for i, low in enumerate(batch.column(1)):
                low = low.as_py()
                found = _hits(low, *automaton) if low is not None else ()
                if found:
                    rows.append(i)
                    hits.append([{"pos": p, "term": terms[j]} for j in found for p in positions[j]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(hits, pa.list_(entry))], ["key", "hits"])

    return run


def match_rules(df: DataFrame, rules: DataFrame, key: str, text: str, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Match every text with a rule table (``pos, term``): ``key, terms`` (by ``pos``), matches only.

    The rules become one automaton, which every task runs once over each of its texts. What is shuffled afterwards is a
    row per text that matches, with its hits: it does not grow with the length of a text. An alphanumeric term must be a whole
    ``[a-z0-9]+`` token of the lower-cased text, any other is searched as a substring; an empty term is in every text, a null
    term in none. Texts of equal keys share a row.

    A table of rules is collected and broadcast only up to ``shard_chars`` characters. A larger one is dealt by hash of the
    term into as many shards as it takes, each an automaton and a pass of its own, so that no task or driver holds more than one.
    """
    spark = df.sparkSession
    is_word = F.coalesce(F.col("term").rlike(r"(?U)\A[\p{Alnum}]+\z"), F.lit(False))
    rules = rules.where("term IS NOT NULL").select("pos", "term", is_word.alias("is_word")).distinct()
    # A rule counts for more than its characters: a place, a list entry, links.
    size = rules.agg(F.sum(F.length("term") + 16).alias("n")).first()["n"] or 0
    shards = max(1, -(-size // shard_chars))
    low = df.select(F.col(key).alias("key"), F.lower(text).alias("low")).where("low IS NOT NULL")
    entry = T.StructType([T.StructField("pos", rules.schema["pos"].dataType), T.StructField("term", T.StringType())])
    schema = T.StructType([T.StructField("key", low.schema["key"].dataType), T.StructField("hits", T.ArrayType(entry))])
    found = None
    for shard in range(shards):
        own = rules.where(F.pmod(F.xxhash64("term"), F.lit(shards)) == shard).collect()
        part = low.mapInArrow(_shard_matcher(own, to_arrow_type(schema["key"].dataType), to_arrow_type(entry), spark), schema)
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"))
    return merged.select(F.col("key").alias(key), F.transform("hits", lambda r: r["term"]).alias("terms"))
