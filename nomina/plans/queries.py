"""Registered queries: each runs one or more operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nomina.functions import markup, text
from nomina.functions.encoding import Encoder, build_vocabulary, max_length
from nomina.operators import cluster, enrich, evaluate, models, network, pairs, search, transformers, tune
from nomina.operators.fuzzyterms import similar_terms
from nomina.operators.gramjoin import nearest_names
from nomina.operators.ranking import take_slice, with_position
from nomina.plans import inputs
from nomina.session import materialize, scratch_path, spread_rows
from nomina.sources import tables
from nomina.sources.index import build_index
from nomina.sources.store import COMPANY_FIELDS, CompanyStore, absent, validate
from nomina.streaming.ingest import stream_into, stream_pages, stream_payloads, table_output

Query = Callable[[SparkSession, str], DataFrame]

N_TRIALS = 20
MODEL_ROWS = 20_000  # pairs that a task encodes or compares for a model


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- Names and pages ---------------------------------------------------------------


def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = inputs.legal_names(spark, sf_dir)
    clean = names.withColumn("normalized", text.normalize(F.col("name")))
    return clean.select("id", "name", "normalized", text.capitalize(F.col("normalized")).alias("capitalized"))


def normalize_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("name")
    return inputs.legal_names(spark, sf_dir).select(
        "id",
        text.lowercase(c).alias("lowercased"),
        text.remove_legal_forms(c).alias("without_legal_forms"),
        text.remove_organisation_suffixes(c).alias("without_suffixes"),
        text.remove_numbers(c).alias("without_numbers"),
        text.remove_non_words(c).alias("without_non_words"),
        text.transliterate(c).alias("transliterated"),
    )


def normalize_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = inputs.legal_names(spark, sf_dir)
    fitted = transformers.normalization_pipeline("name", "normalized").fit(names)
    return fitted.transform(names).select("id", "name", "normalized")


def name_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("name")
    return inputs.legal_names(spark, sf_dir).select(
        "id",
        F.array_join(text.words(c), "|").alias("words"),
        F.array_join(text.index_terms(c), "|").alias("index_terms"),
        text.plus_for_spaces(c).alias("escaped"),
    )


def decoded_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles as a browser would send them, decoded and cleaned."""
    sent = inputs.titles(spark, sf_dir).select(
        F.col("page_id").alias("query_id"), F.replace(F.url_encode("title"), F.lit("+"), F.lit("%20")).alias("query")
    )
    return search.incoming_queries(sent)


def entity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles cut down to the first known name in them; known are the longest words of all titles."""
    t = inputs.titles(spark, sf_dir)
    gazetteer = t.select(inputs.longest_word(F.col("title")).alias("name"))
    return enrich.replace_by_entity(t.select("page_id", "title"), "page_id", "title", gazetteer, max_words=2)


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.PageExtractor().records(inputs.pages(spark, sf_dir))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.allowed_links(inputs.pages(spark, sf_dir))


def first_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.allowed_links(inputs.pages(spark, sf_dir), per_page=2)


def result_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of search-result pages: each page's own hit, then hits without heading and on an excluded site."""
    hit = '<div class="g"><a href="%s"><h3>%s</h3></a><div style="-webkit-line-clamp:2"><span>%s</span></div></div>'
    own = F.format_string(hit, F.replace("url", F.lit("&"), F.lit("&amp;")), "title", "title")
    bare = F.concat(F.lit('<div class="g"><a href="'), F.col("url"), F.lit('"></a></div>'))
    excluded = F.format_string(hit, F.concat(F.lit("https://vk.com/"), F.col("page_id").cast("string")), "title", "title")
    results = inputs.titles(spark, sf_dir).select("page_id", F.concat(F.lit("<html>"), own, bare, excluded).alias("html"))
    return enrich.allowed_links(results, extract=markup.result_links)


def result_links_of_stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages with whole stored pages inside their hits.

    The first hit has its link without quotes and its description after the stored page; in
    the next the description's span comes after its element; the last has its link outside.
    """
    link = F.replace("url", F.lit("&"), F.lit("&amp;"))
    first = ('<html><div class="top g"><div><a class=x href=', link, "><h3>1</h3></a></div>", F.col("html"))
    second = ('<div class="g"><a href="https://none/2"><h3>2</h3></a>', F.col("html"), '<div style="-webkit-line-clamp:2"></div><span>2</span></div>')
    third = '<div class="g"><h3>3</h3><div style="-webkit-line-clamp:2"><span>3</span></div></div><a href="https://none/3"></a>'
    parts = (*first, '<div style="-webkit-line-clamp:2"><b><span>1</span></b></div></div>', *second, third)
    page = F.concat(*(F.lit(part) if isinstance(part, str) else part for part in parts))
    results = inputs.pages(spark, sf_dir).select("page_id", page.alias("html"))
    return enrich.allowed_links(results, extract=markup.result_links)


def record_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the pages offered to suppliers, empty where the url is unknown."""
    offered = inputs.candidate_pages(spark, sf_dir).select("url").distinct()
    unknown = inputs.table(spark, sf_dir, "supplier").select(F.concat(F.lit("https://none/"), "s_name").alias("url"))
    records = enrich.PageExtractor().records(inputs.pages(spark, sf_dir))
    return enrich.lookup_records(offered.unionByName(unknown), records)


# --- Pairs ------------------------------------------------------------------------------


def bulk_load_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.company_frame(inputs.name_pairs(spark, sf_dir))


def bulk_load_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.company_frame(inputs.name_pairs(spark, sf_dir), chunk=1000)


def symmetric_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = inputs.name_pairs(spark, sf_dir).select("name_1", "name_2", "is_duplicate")
    return pairs.symmetric(both)


def distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.distinct_names(inputs.name_pairs(spark, sf_dir))


def swapped_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.swapped(inputs.name_pairs(spark, sf_dir))


def pair_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-duplicate pairs from the hundredth on."""
    negatives = inputs.name_pairs(spark, sf_dir).filter(F.col("is_duplicate") == 0)
    return take_slice(negatives, "pair_id", 100)


def pairs_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs written as CSV with their index column and read back."""
    path = scratch_path(spark, "pairs")
    tables.write_pairs(inputs.name_pairs(spark, sf_dir), path, index=True)
    return tables.read_pairs(spark, path)


def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = pairs.pair_features(inputs.name_pairs(spark, sf_dir))
    return _rounded(features.drop("name_1", "name_2"), "subs_ratio")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = pairs.FuzzyPairClassifier().predict(inputs.name_pairs(spark, sf_dir))
    return scored.select("pair_id", "is_duplicate", "score", "prediction")


def pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_scores(spark, sf_dir), "score").withColumn("verdict", pairs.verdict(F.col("score")))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return with_position(orders, "o_orderkey", ["o_orderstatus"])


def positions_of_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by a hash of their key, as scattered as ids can be."""
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.md5(F.col("o_orderkey").cast("string")).alias("hashed"))
    return with_position(orders, "hashed", ["o_orderstatus"])


def positions_of_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the order of their texts within a language; copies follow each other by id."""
    documents = inputs.table(spark, sf_dir, "documents").select("lang", "text", "doc_id")
    return with_position(documents, "text", ["lang"]).drop("text")


def balanced_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.balanced_split(inputs.name_pairs(spark, sf_dir)).select("pair_id", "is_duplicate", "split")


def kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.stratified_folds(inputs.name_pairs(spark, sf_dir)).select("pair_id", "is_duplicate", "fold")


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.random_split(inputs.name_pairs(spark, sf_dir)).select("pair_id", "split")


# --- Evaluation --------------------------------------------------------------------------


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(_scores(spark, sf_dir))


def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.classification_report(_scores(spark, sf_dir)), "precision", "recall", "f1")


def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.summary(_scores(spark, sf_dir)), "accuracy", "f1", "roc_auc_labels")


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.threshold_sweep(_scores(spark, sf_dir)), "f1")


def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    sweep = evaluate.threshold_sweep(_scores(spark, sf_dir))
    best = evaluate.best_threshold(sweep).withColumn("mode", F.lit("best"))
    last = evaluate.best_threshold(sweep, "last_positive").withColumn("mode", F.lit("last_positive"))
    return _rounded(best.unionByName(last), "f1")


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.roc_auc(_scores(spark, sf_dir)), "roc_auc")


def score_area_of_close_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the ROC curve of scores below a millionth, a third of them piled up at 0 and at 1."""
    pile = F.pmod("pair_id", F.lit(6))
    close = F.when(pile == 0, 0.0).when(pile == 1, 1.0).otherwise(F.col("score") / 2**24)
    return _rounded(evaluate.roc_auc(_scores(spark, sf_dir).withColumn("score", close)), "roc_auc")


# --- Tuning -----------------------------------------------------------------------------------


def trial_list(n: int = N_TRIALS) -> list[tune.Trial]:
    """An arithmetic sequence through the search space."""
    return [
        {"trial_id": i, "threshold": 0.2 + ((i * 7) % n) * 0.8 / n}
        | {f"w_{name}": ((i * (2 * j + 3)) % 11) / 10.0 for j, name in enumerate(pairs.SCORED)}
        for i in range(n)
    ]


def _trial_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = materialize(pairs.pair_features(inputs.name_pairs(spark, sf_dir), blended=False), "tune-features")
    counts = materialize(tune.feature_counts(pairs.stratified_folds(features)), "tune-counts")
    results = tune.evaluate_trials(counts, trial_list())
    return results.withColumn("objective", F.round("objective", 9))


def tune_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(tune.best_trial(_trial_results(spark, sf_dir)), "threshold", "objective")


def trial_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(tune.optimisation_history(_trial_results(spark, sf_dir)), "objective", "best_so_far")


def trial_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(tune.empirical_distribution(_trial_results(spark, sf_dir)), "objective", "share")


def trial_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tune.objective_histogram(_trial_results(spark, sf_dir))


def trial_evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(tune.parameter_evaluations(_trial_results(spark, sf_dir)), "objective", "value")


def weight_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of the search for weights: a hundred random trials, as many as it makes by default."""
    _, log = tune.tune(inputs.name_pairs(spark, sf_dir))
    return _rounded(log, "threshold", *(f"w_{name}" for name in pairs.SCORED), "objective")


# --- Clusters ------------------------------------------------------------------------------


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.name_clusters(inputs.name_pairs(spark, sf_dir))


def name_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clusters(spark, sf_dir)


def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.cluster_sizes(_clusters(spark, sf_dir))


def large_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.large_clusters(_clusters(spark, sf_dir))


def cluster_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.uniqueness(_clusters(spark, sf_dir))


def frontier_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate pairs one step away from the names of all parts."""
    duplicates = pairs.symmetric(
        inputs.name_pairs(spark, sf_dir).filter(F.col("is_duplicate") == 1).select("name_1", "name_2", "is_duplicate")
    )
    frontier = inputs.table(spark, sf_dir, "part").select(F.col("p_name").alias("name_1"))
    return cluster.neighbours(duplicates, frontier)


# --- Encodings --------------------------------------------------------------------------------


def char_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_vocabulary(inputs.name_pairs(spark, sf_dir), ["name_1", "name_2"])


def name_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_length(inputs.name_pairs(spark, sf_dir), ["name_1", "name_2"])


def char_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = inputs.name_pairs(spark, sf_dir)
    encoder = Encoder(build_vocabulary(table, ["name_1", "name_2"]))
    codes = encoder.encode_pair(F.col("name_1"), F.col("name_2"))
    decoded = encoder.decode(encoder.encode(F.col("name_1")))
    return table.select("pair_id", F.array_join(codes, ",").alias("codes"), decoded.alias("decoded"))


# --- Search ---------------------------------------------------------------------------------------


def _index(spark: SparkSession, sf_dir: str) -> search.SearchIndex:
    return build_index(inputs.company(spark, sf_dir))


def term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = materialize(search.distinct_texts(inputs.company(spark, sf_dir)), "texts")
    return _rounded(search.term_statistics(texts), "idf")


def _search(spark: SparkSession, sf_dir: str, fuzziness: int) -> DataFrame:
    found = search.search(_index(spark, sf_dir), inputs.query_names(spark, sf_dir), fuzziness)
    return _rounded(found, "score")


def fuzzy_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, 1)


def fuzzy_search_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, 0)


def fuzzy_search_two_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, 2)


def nearest_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = search.nearest(_index(spark, sf_dir), inputs.mixed_queries(spark, sf_dir))
    return _rounded(best, "score")


def nearest_name_by_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company nearest to names with two typos in every word, and to suppliers' names, which no company has."""
    typed = inputs.titles(spark, sf_dir).select(
        (2 * F.col("page_id")).alias("query_id"), inputs.misspelt_throughout(F.lower("title")).alias("query")
    )
    companies = inputs.company(spark, sf_dir).select("doc_id", F.col("company_name").alias("name"))
    return _rounded(nearest_names(typed.unionByName(inputs.supplier_queries(spark, sf_dir)), companies), "score")


def search_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search results through the nested response form and back to rows."""
    found = search.search(_index(spark, sf_dir), inputs.query_names(spark, sf_dir))
    return _rounded(search.rows_from_response(search.response(found)), "score")


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _insert_if_absent(spark, sf_dir, "relevant")


def insert_if_absent_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _insert_if_absent(spark, sf_dir, "exact")


def _insert_if_absent(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    arriving = inputs.mixed_queries(spark, sf_dir).select(
        text.capitalize(F.col("query")).alias("company_name"),
        F.lit("").alias("company_url"),
        F.col("query").alias("query_string"),
        F.col("query").alias("normalized_name"),
    )
    stored = inputs.company(spark, sf_dir)
    return absent(stored if mode == "relevant" else stored.drop("doc_id"), arriving, mode)


def _enriched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return enrich.search_then_enrich(
        _index(spark, sf_dir),
        inputs.mixed_queries(spark, sf_dir),
        inputs.candidate_pages(spark, sf_dir),
        inputs.pages(spark, sf_dir),
    )


def search_then_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_enriched(spark, sf_dir)[0], "score")


def enrichment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir)[1]


def fuzzy_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all queries with the index terms one edit away."""
    return _fuzzy_terms(spark, sf_dir, 1)


def fuzzy_terms_two_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fuzzy_terms(spark, sf_dir, 2)


def _fuzzy_terms(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    words = inputs.query_names(spark, sf_dir).select(F.explode(text.index_terms(F.col("query"))).alias("token")).distinct()
    texts = search.distinct_texts(inputs.company(spark, sf_dir))
    vocabulary = texts.select(F.explode("counts.term").alias("term")).distinct()
    return _rounded(similar_terms(words, vocabulary, limit).drop("distance"), "weight")


def fuzzy_long_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries with their words run together, and the titles run together that are two edits away."""

    def joined(df: DataFrame, column: Column, name: str) -> DataFrame:
        return df.select(F.replace(column, F.lit(" "), F.lit("")).alias(name)).distinct()

    tokens = joined(inputs.query_names(spark, sf_dir), F.col("query"), "token")
    vocabulary = joined(inputs.titles(spark, sf_dir), F.lower("title"), "term")
    return _rounded(similar_terms(tokens, vocabulary, 2).drop("distance"), "weight")


def bulk_loaded_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bulk-load frame through a new company store."""
    store = CompanyStore(spark, scratch_path(spark, "store"))
    store.create()
    store.bulk_load(bulk_load_frame(spark, sf_dir))
    return store.read()


def restored_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies written as an index dump and restored into a new store."""
    dump = scratch_path(spark, "dump")
    companies = inputs.company(spark, sf_dir)
    companies.select(F.col("doc_id").alias("_id"), F.struct(*COMPANY_FIELDS).alias("_source")).write.json(dump)
    store = CompanyStore(spark, scratch_path(spark, "store"))
    store.create()
    store.restore(dump)
    return store.read()


def validated_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert payloads of all companies, and of all suppliers without a url: which are records."""
    companies = inputs.company(spark, sf_dir).select(F.to_json(F.struct(*COMPANY_FIELDS)).alias("value"))
    partial = F.struct(F.col("s_name").alias("company_name"), F.lower("s_name").alias("normalized_name"))
    suppliers = inputs.table(spark, sf_dir, "supplier").select(F.to_json(partial).alias("value"))
    valid, rejected = validate(companies.unionByName(suppliers))
    name = F.get_json_object("value", "$.company_name")
    return valid.select("company_name", F.lit(True).alias("valid")).unionByName(
        rejected.select(name.alias("company_name"), F.lit(False).alias("valid"))
    )


def stream_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page records through the stream into a new store that already holds the supplier names."""
    store = CompanyStore(spark, scratch_path(spark, "store"))
    store.create()
    suppliers = inputs.supplier_queries(spark, sf_dir).select(
        text.capitalize(F.col("query")).alias("company_name"),
        F.lit("").alias("company_url"),
        F.col("query").alias("query_string"),
        F.col("query").alias("normalized_name"),
    )
    store.append(suppliers, "suppliers")
    pages = inputs.page_stream(spark, sf_dir)
    records = enrich.PageExtractor().records(pages).filter(F.col("status") == "ok").select(*COMPANY_FIELDS)
    stream_into(records, store, scratch_path(spark, "stream")).awaitTermination()
    return store.read()


def stream_insert_relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the store's search index: page names that resemble no supplier's, one of each."""
    store = CompanyStore(spark, scratch_path(spark, "store"))
    store.create()
    store.append(_named(inputs.query_names(spark, sf_dir).filter(F.col("query_id") % 2 == 0)), "queries")
    pages = inputs.page_stream(spark, sf_dir)
    records = enrich.PageExtractor().records(pages).filter(F.col("status") == "ok").select(*COMPANY_FIELDS)
    stream_into(records, store, scratch_path(spark, "stream"), mode="relevant").awaitTermination()
    return store.read()


def _heading(html: Column) -> Column:
    return F.regexp_extract(html, "<h1>(.*?)</h1>", 1)


def stream_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and headings of a stream of pages, as a side output of inserting their records keeps them."""
    pages = inputs.page_stream(spark, sf_dir)
    store, values = CompanyStore(spark, scratch_path(spark, "store")), scratch_path(spark, "values")
    extractor = enrich.PageExtractor().add_extractor(_heading)
    stream_pages(pages, extractor, store, scratch_path(spark, "stream"), [table_output(values)]).awaitTermination()
    return spark.read.parquet(values).select("url", "value")


def _named(queries: DataFrame) -> DataFrame:
    """Records that hold nothing but a query."""
    query = F.col("query")
    return queries.select(text.capitalize(query).alias("company_name"), F.lit("").alias("company_url"), query.alias("query_string"), query.alias("normalized_name"))


def _kept_and_rejected(stored: DataFrame, rejected: DataFrame, raw: str) -> DataFrame:
    kept = stored.select(F.lit("stored").alias("outcome"), F.col("company_name").alias("what"))
    return kept.unionByName(rejected.select(F.lit("rejected").alias("outcome"), F.col(raw).alias("what")))


def _partial_lines(spark: SparkSession, sf_dir: str, under: str) -> DataFrame:
    """JSON of all suppliers without most fields, and one broken line per part."""
    partial = F.concat(F.lit(under), F.lit('{"company_name": "'), F.col("s_name"), F.lit('"}'), F.lit("}" if under else "")).alias("value")
    broken = F.concat(F.lit('{"company_name": "'), F.col("p_name")).alias("value")
    return inputs.table(spark, sf_dir, "supplier").select(partial).unionByName(inputs.table(spark, sf_dir, "part").select(broken))


def restored_dump_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump of all companies with incomplete and broken lines: what is stored, and the lines set apart as they were."""
    dump, quarantine = scratch_path(spark, "dump"), scratch_path(spark, "quarantine")
    good = inputs.company(spark, sf_dir).select(F.to_json(F.struct(F.struct(*COMPANY_FIELDS).alias("_source"))).alias("value"))
    good.unionByName(_partial_lines(spark, sf_dir, '{"_source": ')).write.text(dump)
    store = CompanyStore(spark, scratch_path(spark, "store"))
    store.create()
    store.restore(dump, "dump", quarantine)
    return _kept_and_rejected(store.read(), spark.read.parquet(f"{quarantine}/dump"), "line")


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as a stream of payloads."""
    source, quarantine = scratch_path(spark, "payloads"), scratch_path(spark, "quarantine")
    good = inputs.company(spark, sf_dir).select(F.to_json(F.struct(*COMPANY_FIELDS)).alias("value"))
    good.unionByName(_partial_lines(spark, sf_dir, "")).write.text(source)
    store = CompanyStore(spark, scratch_path(spark, "store"))
    stream_payloads(spark.readStream.text(source), store, scratch_path(spark, "stream"), quarantine, check_exists=False).awaitTermination()
    return _kept_and_rejected(store.read(), spark.read.option("recursiveFileLookup", "true").parquet(quarantine), "value")


def insert_batch_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies, each once more without its url: the complete record of each name is stored, the other set apart."""
    quarantine = scratch_path(spark, "quarantine")
    complete = inputs.company(spark, sf_dir).select(*COMPANY_FIELDS)
    twice = complete.unionByName(complete.withColumn("company_url", F.lit(None).cast("string")))
    store = CompanyStore(spark, scratch_path(spark, "store"))
    store.create()
    store.insert(twice, check_exists=True, mode="exact", load="all", quarantine=quarantine)
    return _kept_and_rejected(store.read(), spark.read.parquet(f"{quarantine}/all"), "company_name")


def segmented_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All queries against a store filled by four loads, a segment of the index each."""
    store = CompanyStore(spark, scratch_path(spark, "store"))
    store.create()
    companies = materialize(inputs.company(spark, sf_dir), "companies")
    for n in range(4):
        store.append(companies.filter(F.col("doc_id") % 4 == n).select(*COMPANY_FIELDS), f"load-{n}")
    return _rounded(search.search(store.index(), inputs.query_names(spark, sf_dir)), "score")


def stored_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that the fallback finds are stored; the queries that led to them are searched again, in the store."""
    store = CompanyStore(spark, scratch_path(spark, "store"))
    store.create()
    store.append(enrichment_records(spark, sf_dir), "fallback")
    found = search.nearest(store.index(), inputs.supplier_queries(spark, sf_dir), fuzziness=0)
    return _rounded(found.filter(F.col("match_key") == F.col("query")).select("query_id", "query", "company_name", "company_url", "score"), "score")


def fuzzy_search_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search with an index in which every term of more than three texts is hot."""
    index = build_index(inputs.company(spark, sf_dir), hot_texts=3)
    return _rounded(search.search(index, inputs.query_names(spark, sf_dir)), "score")


def fuzzy_search_hot_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(inputs.company(spark, sf_dir), hot_texts=3)
    return _rounded(search.search(index, inputs.query_names(spark, sf_dir), 0), "score")


# --- Models ------------------------------------------------------------------------------------


def gbt_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees on the six features, evaluated on the balanced test rows.

    A tenth of the training rows, by a hash of their ids, decides when to stop; the test rows take no part.
    """
    table = spread_rows(pairs.balanced_split(inputs.name_pairs(spark, sf_dir)), "balanced-pairs", MODEL_ROWS)
    features = materialize(pairs.pair_features(table), "model-features")
    train = features.filter("split <> 'test'").withColumn("is_validation", F.pmod(F.xxhash64("pair_id"), F.lit(10)) == 0)
    model = models.boosted_trees(train, validation="is_validation")
    scored = models.compare_names(model, features.filter("split = 'test'"))
    return scored.select("pair_id", "is_duplicate", "score", "verdict", F.lit(model.stages[-1].getNumTrees).alias("trees"))


def gbt_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the trees' scores of the test rows are worth."""
    scored = materialize(gbt_pairs(spark, sf_dir), "scored-pairs")
    return _rounded(evaluate.learned_report(scored), "precision", "recall", "f1", "roc_auc")


def _network(spark: SparkSession, sf_dir: str) -> tuple[network.NetworkModel, DataFrame]:
    table = spread_rows(pairs.random_split(inputs.name_pairs(spark, sf_dir)), "model-pairs", MODEL_ROWS)
    encoder = Encoder(build_vocabulary(table, ["name_1", "name_2"]))
    encoded = models.encoded_pairs(table, encoder).select("pair_id", "is_duplicate", "split", "features")
    encoded = materialize(encoded, "encoded-pairs")
    return network.train_network(encoded.filter("split = 'train'"), inputs=2 * encoder.length), encoded.filter("split = 'test'")


def network_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss and accuracy of each epoch of the network on character codes."""
    return _network(spark, sf_dir)[0].epochs


def network_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the network's scores of the test rows are worth."""
    model, test = _network(spark, sf_dir)
    scored = materialize(model.transform(test).drop("features"), "scored-pairs")
    return _rounded(evaluate.learned_report(scored), "precision", "recall", "f1", "roc_auc")


def mlp_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perceptron on character codes, evaluated on the test rows of the random split."""
    table = spread_rows(pairs.random_split(inputs.name_pairs(spark, sf_dir)), "model-pairs", MODEL_ROWS)
    encoder = Encoder(build_vocabulary(table, ["name_1", "name_2"]))
    encoded = models.encoded_pairs(table, encoder)
    train = materialize(encoded.filter(F.col("split") == "train").select("is_duplicate", "features"), "model-train")
    model = models.perceptron(train, inputs=2 * encoder.length)
    return models.compare_names(model, encoded.filter(F.col("split") == "test")).select(
        "pair_id", "is_duplicate", "score", "verdict"
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        normalize_names, normalize_steps, normalize_pipeline, name_tokens, decoded_queries, entity_names,
        page_records, page_links, first_page_links, result_links, result_links_of_stored_pages, record_lookup,
        bulk_load_frame, bulk_load_chunks, distinct_names, swapped_pairs, symmetric_pairs, pair_slice, pairs_csv,
        pair_features, pair_scores, positions, positions_of_hashes, positions_of_texts, balanced_split, kfold, random_split,
        confusion, classification_report, score_summary, threshold_sweep, best_threshold, roc_auc, score_area_of_close_scores,
        tune_weights, trial_history, trial_distribution, trial_histogram, trial_evaluations, weight_search,
        name_clusters, cluster_sizes, large_clusters, cluster_uniqueness, frontier_neighbours,
        char_vocab, name_length, char_encode,
        term_stats, fuzzy_terms, fuzzy_terms_two_edits, fuzzy_long_terms, fuzzy_search, fuzzy_search_exact, fuzzy_search_two_edits, nearest_name, nearest_name_by_grams, search_response,
        insert_if_absent, insert_if_absent_exact, search_then_enrich, enrichment_records,
        bulk_loaded_store, restored_store, validated_payloads, stream_insert, stream_insert_relevant, stream_values,
        restored_dump_with_rejects, quarantined_rows, insert_batch_once, segmented_search, stored_enrichment,
        fuzzy_search_hot, fuzzy_search_hot_exact,
        gbt_pairs, gbt_report, mlp_pairs, network_epochs, network_report,
    )
}
