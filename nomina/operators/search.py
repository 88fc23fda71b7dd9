"""Typo-tolerant search of many names at once over a table of companies.

Per query and field the ten best documents by BM25 are found, relevant ones kept,
collapsed by their shortest name and merged over the fields.

What keeps the work in proportion to queries:

* equal query strings are searched once, and documents with equal text in a field are
  one *text* that stands for its first ten documents;
* a query meets a text through the terms they share, never by pairing them all;
* terms found in more than a fixed number of texts are *hot* and get no postings of their own.
  What they add to a score travels with the few hot terms of a text and of a query.

Texts that share nothing but hot terms with a query are found in blocks. Texts with equal hot
terms are one group, of which the ten shortest are all that can place. Groups are ordered by
their rarest terms first and cut into blocks of blocks; a block knows the largest frequency and
least length of each term inside it, and so a bound of what any of its texts can score. Queries
whose hot terms could beat their tenth text so far are open. Where the groups have more than
``MOST_MEMBERS`` texts, open queries descend level by level with the ten best blocks of each level only,
which raises the tenth score. Those that are open still meet all groups, so the result is exact either way.

Queries meet texts in blocks (``nomina.operators.termproduct``), so single matches never become rows.

An index consists of segments (``nomina.sources.index``): each has texts, postings and blocks of
its own, and a search adds their document counts up before it ranks, so the result is that of
one index over all documents.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomina.functions.similarity import with_token_set_ratio
from nomina.functions.text import index_terms, normalize, percent_decode
from nomina.operators.fuzzyterms import similar_terms
from nomina.operators.ranking import first_per_group
from nomina.operators.termproduct import best_texts
from nomina.session import materialize, spread

# Searched fields in merge order, and the constants of ranking and relevance.
FIELDS = ("company_name", "company_url", "normalized_name", "query_string")
FUZZINESS = (0, 1, 2)
PAGE_SIZE = 10
K1, B = 1.2, 0.75
MOST_MEMBERS = 1 << 20  # texts in groups of hot terms up to which to add them up costs less than the rows of a descent
LEAST_ENGINE_SCORE = 0.01
LEAST_SCORE = 0.3

SCORE_DIGITS = 9
_ROUNDING = 10.0**-SCORE_DIGITS


@dataclass(frozen=True)
class FieldStatistics:
    """What ranking needs to know about a field; two numbers per field."""

    n_docs: int
    mean_length: float


@dataclass(frozen=True)
class SearchIndex:
    """Stored tables behind a search, each with a ``segment`` number.

    ``documents(doc_id, <all fields>)``; ``texts(field, text_id, length, rare, hot_tf)`` with
    the ``(term, tf)`` of each distinct text; ``terms(field, term, df, is_hot, max_tf,
    min_length)``; ``text_documents(field, text_id, doc_id)`` with the first documents of each
    text; ``nodes(level, field, parent, node, term, max_tf, min_length, least_id)`` with the
    blocks of hot terms and ``members(field, node, text_id, length, hot_tf)`` with the texts of
    the lowest ones. ``levels`` has the top level of each segment with hot terms.
    """

    documents: DataFrame
    texts: DataFrame
    terms: DataFrame
    text_documents: DataFrame
    nodes: DataFrame
    members: DataFrame
    fields: tuple[str, ...]
    statistics: dict[str, FieldStatistics]
    segments: tuple[int, ...]
    levels: dict[int, int]

    def only(self, fields: Sequence[str]) -> SearchIndex:
        """The same index searched in some of its fields."""
        check_fields(fields, self.fields)
        return replace(self, fields=tuple(f for f in self.fields if f in fields))


def as_rows(documents: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``(doc_id, field, text)``: one row per field that is not empty."""
    cells = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields))
    return documents.select("doc_id", F.inline(cells)).filter(F.col("text") != "")


def with_term_counts(df: DataFrame, text: Column) -> DataFrame:
    """Add ``length`` and ``counts``, the distinct terms of a text with their frequencies.

    Runs of the sorted terms are counted, so a long text costs a sort. Each step is a column
    of its own: inside a lambda it would be computed once per element.
    """
    sorted_terms = df.withColumn("_terms", F.sort_array(index_terms(text)))
    places = F.when(F.size("_terms") > 0, F.sequence(F.lit(0), F.size("_terms") - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: (i == 0) | (F.get("_terms", i - 1) != F.get("_terms", i)))
    begun = sorted_terms.withColumn("_starts", starts)
    counts = F.transform(
        "_starts",
        lambda at, i: F.struct(F.get("_terms", at).alias("term"), (F.coalesce(F.get("_starts", i + 1), F.size("_terms")) - at).alias("tf")),
    )
    return begun.withColumns({"length": F.size("_terms"), "counts": counts}).drop("_terms", "_starts")


def distinct_texts(documents: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """``(field, text_id, n_docs, length, counts)``: texts with at least one term; the id is the first document's."""
    grouped = as_rows(documents, fields).groupBy("field", "text").agg(
        F.min("doc_id").alias("text_id"), F.count("*").alias("n_docs")
    )
    counted = with_term_counts(grouped, F.col("text")).filter(F.col("length") > 0)
    return counted.select("field", "text_id", "n_docs", "length", "counts")


def field_totals(texts: DataFrame) -> DataFrame:
    """``(field, n_docs, total_length)``: one row per field."""
    return texts.groupBy("field").agg(F.sum("n_docs").alias("n_docs"), F.sum(F.col("n_docs") * F.col("length")).alias("total_length"))


def add_up(rows: Sequence) -> dict[str, FieldStatistics]:
    """Statistics of all segments from their totals."""
    fields = {row["field"] for row in rows}
    docs = {f: sum(row["n_docs"] for row in rows if row["field"] == f) for f in fields}
    length = {f: sum(row["total_length"] for row in rows if row["field"] == f) for f in fields}
    return {f: FieldStatistics(docs[f], length[f] / docs[f]) for f in fields}


def term_totals(texts: DataFrame) -> DataFrame:
    """Per field and term: documents and texts with it, its largest frequency and its shortest text."""
    terms = texts.select("field", "n_docs", "length", F.inline("counts"))
    return terms.groupBy("field", "term").agg(
        F.sum("n_docs").alias("df"), F.count("*").alias("n_texts"), F.max("tf").alias("max_tf"), F.min("length").alias("min_length")
    )


def idf(n_docs: Column, df: Column) -> Column:
    return F.log1p((n_docs - df + 0.5) / (df + 0.5))


def term_statistics(texts: DataFrame) -> DataFrame:
    """``(field, term, df, idf)`` of all terms."""
    totals = add_up(field_totals(texts).collect())  # one row per searched field
    terms = term_totals(texts)
    return terms.select("field", "term", "df", idf(_per_field({f: x.n_docs for f, x in totals.items()}), F.col("df")).alias("idf"))


def _per_field(values: dict[str, float]) -> Column:
    """A number that depends on the field, as a constant lookup."""
    out = F.lit(None).cast("double")
    for name, value in values.items():
        out = F.when(F.col("field") == name, F.lit(float(value))).otherwise(out)
    return out


def factor(tf: Column, norm: Column) -> Column:
    """What one term of a text adds to a score, before its weight; falls as the text gets longer."""
    return (K1 + 1) * tf / (tf + norm)


def _norm(statistics: dict[str, FieldStatistics], length: str = "length") -> Column:
    share = F.col(length) / _per_field({f: x.mean_length for f, x in statistics.items()})
    return K1 * (1 - B + B * share)


def check_fields(fields: Sequence[str], known: Sequence[str] = FIELDS) -> None:
    unknown = set(fields) - set(known)
    if unknown or not fields:
        raise ValueError(f"fields must be among {known}, not {sorted(unknown)}")


def _hot_gain(entry: Column, bag: Column, norm: Column) -> Column:
    return F.coalesce(entry["weight"] * factor(F.try_element_at(bag, entry["term"]), norm), F.lit(0.0))


def _hot_score(weights: Column, bag: Column, norm: Column) -> Column:
    """Sum over hot terms that a query (weighted terms) and a text (map of frequencies) share."""
    score = F.aggregate(weights, F.lit(0.0), lambda total, entry: total + _hot_gain(entry, bag, norm))
    return F.when((F.size(weights) > 0) & (F.size(bag) > 0), score).otherwise(0.0)


def _profiles(index: SearchIndex, queries: DataFrame, fuzziness: int) -> DataFrame:
    """``(query_no, segment, field, hot, rare)``: weighted index terms each query reaches in each field."""
    # Not ``inline``: Spark would filter on the size of the counts first, and compute them inside that filter.
    counted = with_term_counts(queries, F.col("query")).select("query_no", F.inline_outer("counts"))
    tokens = counted.filter(F.col("term").isNotNull()).withColumnRenamed("term", "token")
    terms = index.terms.filter(F.col("field").isin(list(index.fields)))
    reached = similar_terms(tokens.select("token").distinct(), terms.select("term").distinct(), fuzziness)
    # Few and small rows, each of which meets all queries with its token.
    reached = materialize(reached, "reached-terms", spread_by="term")
    # Dealt by query once, for both groupings and the stored rows.
    weighed = spread(tokens.join(reached, "token").join(terms, "term"), "query_no")
    keys = ["query_no", "segment", "field", "term", "is_hot", "df", "max_tf", "min_length"]
    weighed = weighed.groupBy(*keys).agg(F.sum(F.col("tf") * F.col("weight")).alias("weight"))
    if len(index.segments) > 1:  # documents with the term in all segments, of which a query and term have a row each
        weighed = weighed.withColumn("df", F.sum("df").over(Window.partitionBy("query_no", "field", "term")))
    n_docs = _per_field({f: x.n_docs for f, x in index.statistics.items()})
    ceiling = factor(F.col("max_tf"), _norm(index.statistics, "min_length"))
    weighed = weighed.withColumn("weight", F.col("weight") * idf(n_docs, F.col("df"))).withColumn("ceiling", ceiling)
    rare, hot = F.struct("term", "weight"), F.struct("term", "weight", "ceiling")
    return weighed.groupBy("query_no", "segment", "field").agg(
        F.sort_array(F.collect_list(F.when(F.col("is_hot"), hot))).alias("hot"),
        F.collect_list(F.when(~F.col("is_hot"), rare)).alias("rare"),
    )


def _best(scored: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    return first_per_group(scored, keys, [F.desc("engine_score"), F.col(item)], PAGE_SIZE)


def _field_no() -> Column:
    return F.array_position(F.lit(list(FIELDS)), F.col("field")).cast("int")


def _lists(kind: str, entries: Column, name: str, value: Callable[[Column], Column]) -> list[Column]:
    """Two lists that a product of terms reads; a term of another segment is another term."""
    terms = F.transform(entries, lambda x: F.xxhash64(F.col("segment"), x[name]))
    return [terms.alias(f"{kind}_terms"), F.transform(entries, value).alias(f"{kind}_values")]


def _by_rare_terms(index: SearchIndex, profiles: DataFrame) -> DataFrame:
    """The best texts that share a rare term with a query, by all terms."""

    def table(df: DataFrame, key: str, value: Callable[[Column], Column]) -> DataFrame:
        lists = [column for kind in ("rare", "hot") for column in _lists(kind, F.col(kind), "term", value)]
        return df.filter(F.size("rare") > 0).select(key, _field_no().alias("group_no"), *lists)

    searched = index.texts.filter(F.col("field").isin(list(index.fields))).withColumn("norm", _norm(index.statistics))
    wanted = table(profiles, "query_no", lambda x: x["weight"])
    texts = table(searched, "text_id", lambda x: factor(x["tf"], F.col("norm")))
    scored = best_texts(wanted, texts, PAGE_SIZE, SCORE_DIGITS)
    best = _best(scored.withColumn("engine_score", F.round("engine_score", SCORE_DIGITS)), ["query_no", "group_no"], "text_id")
    return best.select("query_no", F.element_at(F.lit(list(FIELDS)), F.col("group_no")).alias("field"), "text_id", "engine_score")


_HEAD = ["segment", "field", "head_no"]


def _descend(index: SearchIndex, heads: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Groups of texts that queries reach through the blocks that ``keep`` leaves at each level.

    ``heads(segment, field, head_no, hot)`` are queries; returns their keys, ``hot`` and ``node``.
    """
    wanted = heads.select(*_HEAD, F.inline("hot"))
    gain = F.col("weight") * factor(F.col("max_tf"), _norm(index.statistics, "min_length"))
    top, reached = max(index.levels.values()), None
    for level in range(top, -1, -1):
        starting = [s for s, t in index.levels.items() if t == level]
        begun = heads.filter(F.col("segment").isin(starting)).select(*_HEAD, F.lit(0).cast("long").alias("parent"))
        reached = begun if reached is None else reached.withColumnRenamed("node", "parent").unionByName(begun)
        blocks = index.nodes.filter(F.col("level") == level).drop("level")
        met = wanted.join(reached, _HEAD).join(blocks, ["segment", "field", "parent", "term"])
        bounds = met.groupBy(*_HEAD, "node").agg(F.sum(gain).alias("bound"), F.min("least_id").alias("least_id"))
        reached = keep(bounds).select(*_HEAD, "node")
    return reached.join(heads, _HEAD)


def _scored(index: SearchIndex, groups: DataFrame) -> DataFrame:
    """The best texts of each head among the members of groups."""
    met = groups.join(index.members, ["segment", "field", "node"])
    score = F.round(_hot_score(F.col("hot"), F.col("hot_tf"), _norm(index.statistics)), SCORE_DIGITS)
    return _best(met.select(*_HEAD, "text_id", score.alias("engine_score")), _HEAD, "text_id")


def _by_hot_terms(index: SearchIndex, heads: DataFrame) -> DataFrame:
    """The best texts of each head among the members of all groups, found by its hot terms."""
    n = len(FIELDS) + 1
    group = (F.col("segment") * n + _field_no()).cast("int").alias("group_no")
    none = [F.array().cast(kind).alias(f"hot_{name}") for name, kind in (("terms", "array<long>"), ("values", "array<double>"))]
    wanted = heads.select(F.col("head_no").alias("query_no"), group, *_lists("rare", F.col("hot"), "term", lambda x: x["weight"]), *none)
    normed = index.members.filter(F.col("field").isin(list(index.fields))).withColumn("norm", _norm(index.statistics))
    gains = _lists("rare", F.map_entries("hot_tf"), "key", lambda x: factor(x["value"], F.col("norm")))
    scored = best_texts(wanted, normed.select("text_id", group, *gains, *none), PAGE_SIZE, SCORE_DIGITS, one_per_id=False)
    of_heads = scored.select(
        F.floor(F.col("group_no") / n).cast("int").alias("segment"),
        F.element_at(F.lit(list(FIELDS)), F.col("group_no") % n).alias("field"),
        F.col("query_no").alias("head_no"),
        "text_id",
        F.round("engine_score", SCORE_DIGITS).alias("engine_score"),
    )
    return _best(of_heads, _HEAD, "text_id")


def _with_hot_terms(index: SearchIndex, profiles: DataFrame, by_rare: DataFrame) -> DataFrame:
    """Complete the best texts with those that share only hot terms with a query."""
    # Queries with equal hot terms and weights in a field are one head, known by its first query.
    with_hot = profiles.filter(F.size("hot") > 0).select("query_no", "segment", "field", "hot")
    numbers = with_hot.groupBy("segment", "field", "hot").agg(F.min("query_no").alias("head_no"))
    queries = materialize(with_hot.join(numbers, ["segment", "field", "hot"]), "hot-queries")
    heads = queries.filter(F.col("query_no") == F.col("head_no")).drop("query_no")

    def merged(found: DataFrame, of_heads: DataFrame) -> DataFrame:
        of_queries = queries.select("query_no", *_HEAD).join(of_heads, _HEAD).select(*found.columns)
        # A text found both ways has its full score, the larger one, from its rare terms.
        both = found.unionByName(of_queries).groupBy("query_no", "field", "text_id")
        return _best(both.agg(F.max("engine_score").alias("engine_score")), ["query_no", "field"], "text_id")

    def ten_best(bounds: DataFrame) -> DataFrame:
        return first_per_group(bounds, _HEAD, [F.desc("bound"), F.col("least_id"), F.col("node")], PAGE_SIZE)

    def undecided(found: DataFrame, descended: bool) -> DataFrame:
        """Heads of queries with a tenth text that hot terms alone could beat, or, before the descent, without one."""
        tenth = found.groupBy("query_no", "field").agg(F.count("*").alias("n"), F.min("engine_score").alias("tenth")).filter(F.col("n") >= PAGE_SIZE)
        reachable = F.aggregate("hot", F.lit(0.0), lambda s, x: s + x["weight"] * x["ceiling"])
        # Fewer than ten texts after it: no level had more than ten blocks, so nothing was left out.
        met = queries.join(tenth, ["query_no", "field"], "inner" if descended else "left")
        could = met.filter(F.col("tenth").isNull() | (reachable + _ROUNDING >= F.col("tenth")))
        return materialize(heads.join(could.select(*_HEAD).distinct(), _HEAD), "open-heads")

    found = materialize(by_rare, "found")
    still_open = undecided(found, descended=False)
    if index.members.count() > MOST_MEMBERS and not still_open.isEmpty():
        found = materialize(merged(found, _scored(index, _descend(index, still_open, ten_best))), "found")
        still_open = undecided(found, descended=True)
    return found if still_open.isEmpty() else merged(found, _by_hot_terms(index, still_open))


def field_hits(index: SearchIndex, queries: DataFrame, fuzziness: int = 1) -> DataFrame:
    """``(query_no, field, hit_rank, doc_id, engine_score)``: the ten best documents per query and field.

    ``queries(query_no, query)`` holds distinct strings.
    """
    if fuzziness not in FUZZINESS:
        raise ValueError(f"fuzziness must be one of {FUZZINESS}, not {fuzziness!r}")
    profiles = materialize(_profiles(index, queries, fuzziness), "profiles")
    texts = _by_rare_terms(index, profiles)
    if index.levels:
        texts = _with_hot_terms(index, profiles, texts)
    ranked = Window.partitionBy("query_no", "field").orderBy(F.desc("engine_score"), "doc_id")
    documents = texts.join(index.text_documents.drop("segment"), ["field", "text_id"])
    return (
        documents.withColumn("hit_rank", F.row_number().over(ranked))
        .filter(F.col("hit_rank") <= PAGE_SIZE)
        .select("query_no", "field", "hit_rank", "doc_id", "engine_score")
    )


def shortest_value(fields: Sequence[str]) -> Column:
    """Shortest non-empty field value; the first field wins ties. NULL when all are empty."""
    values = F.array(*(F.struct(F.length(f).alias("n"), F.lit(i).alias("i"), F.col(f).alias("v")) for i, f in enumerate(fields)))
    return F.array_min(F.filter(values, lambda x: x["v"] != ""))["v"]


def search(
    index: SearchIndex,
    queries: DataFrame,
    fuzziness: int = 1,
    key_order: Sequence[str] = FIELDS,
    least_score: float = LEAST_SCORE,
    matcher: str = "indel",
) -> DataFrame:
    """Merged matches of ``queries(query_id, query)``, best first within a query.

    Returns ``(query_id, query, position, match_key, score, company_name, company_url,
    normalized_name)``; queries without a match have no row. ``key_order`` is the order of
    fields inside a document, which settles which of two equally short values names it.
    """
    return _search(index, _stored(queries), fuzziness, key_order, least_score, matcher)


def _stored(queries: DataFrame) -> DataFrame:
    return materialize(queries.select("query_id", "query"), "queries")


def _search(
    index: SearchIndex, queries: DataFrame, fuzziness: int, key_order: Sequence[str], least_score: float, matcher: str
) -> DataFrame:
    distinct = queries.groupBy("query").agg(F.min("query_id").alias("query_no"))
    hits = field_hits(index, distinct, fuzziness).filter(F.col("engine_score") > LEAST_ENGINE_SCORE)
    field_no = F.array_position(F.lit(list(index.fields)), F.col("field"))
    named = hits.join(index.documents.drop("segment"), "doc_id").withColumn("match_key", shortest_value(key_order))
    payload = F.struct("company_name", "company_url", "normalized_name")
    # One pass for both collapses: the last hit of the first field gives the payload, the
    # first hit of the first field the place in the merged list.
    merged = named.groupBy("query_no", "match_key").agg(
        F.min_by(payload, F.struct(field_no.alias("f"), (-F.col("hit_rank")).alias("r"))).alias("payload"),
        F.min(F.struct(field_no.alias("f"), F.col("hit_rank").alias("r"))).alias("place"),
    )
    # The score depends on query and key only, so it is computed once per merged match.
    named = merged.join(distinct, "query_no")
    rated = with_token_set_ratio(named, F.col("query"), F.col("match_key"), matcher=matcher)
    scored = rated.withColumn("score", F.col("token_set_ratio") / 100)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "place")
    matches = scored.filter(F.col("score") > least_score).select(
        "query", F.row_number().over(order).alias("position"), "match_key", "score", "payload.*"
    )
    return queries.join(matches, "query").select(
        "query_id", "query", "position", "match_key", "score", "company_name", "company_url", "normalized_name"
    )


def nearest(
    index: SearchIndex,
    queries: DataFrame,
    fuzziness: int = 1,
    key_order: Sequence[str] = FIELDS,
    least_score: float = LEAST_SCORE,
    matcher: str = "indel",
) -> DataFrame:
    """The nearest known company per query, or ``exists = false``."""
    queries = _stored(queries)
    best = _search(index, queries, fuzziness, key_order, least_score, matcher).filter(F.col("position") == 1).drop("query", "position")
    joined = queries.join(best, "query_id", "left")
    return joined.withColumn("exists", F.col("match_key").isNotNull())


def incoming_queries(raw: DataFrame) -> DataFrame:
    """Queries as a web form sends them: percent-decoded, then cleaned like stored names."""
    return raw.withColumn("query", normalize(percent_decode(F.col("query"))))


def response(matches: DataFrame) -> DataFrame:
    """Nested form per query: a map from match key to its fields."""
    fields = ("score", "company_name", "company_url", "normalized_name")
    entry = F.struct("position", "match_key", F.struct(*fields).alias("value"))
    gathered = matches.groupBy("query_id", "query").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    return gathered.select("query_id", "query", F.map_from_arrays("entries.match_key", "entries.value").alias("matches"))


def rows_from_response(responses: DataFrame) -> DataFrame:
    """Back from the nested form to rows, best score first, the score also as text with two decimals."""
    rows = responses.select("query_id", "query", F.explode("matches").alias("match_key", "value"))
    flat = rows.select("query_id", "query", "match_key", "value.*")
    return flat.withColumn("score_text", F.format_number("score", 2))
