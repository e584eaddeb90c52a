"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from loglens.functions.parsing import (
    minute_stamp,
    parse_combined_log,
    parse_log_time,
    split_csv_line,
    strip_commas,
)
from loglens.functions.split import hash_split, is_train
from loglens.operators import (
    enrich,
    features,
    jsonflat,
    metrics,
    models,
    rules,
    token_vectors,
)
from loglens.operators.prepare import (
    accumulate,
    feature_rows,
    is_complete,
    project_log_features,
    response_to_double,
)
from loglens.plans.log_analysis import analyse_logs
from loglens.schema import LOG_SCHEMA
from loglens.session import new_path, spread_small_input, written
from loglens.sinks import files
from loglens.sources import kafka, logs, message_log, synthetic
from loglens.sources.tables import (
    address_ranges,
    event_places,
    location_ranges,
    log_lines,
    log_records,
    parsed_logs,
    raw_lines,
    stream_log_records,
    stream_table,
    table,
    with_log_line,
)
from loglens.streaming import ingest, minute_rules, windows

FOUR = features.PRESETS["four"].inputs

# Centres (response, requestIndex) that define the clusters of most queries.
CENTRES = (
    (0, (200.0, 20.0)),
    (1, (200.0, 100.0)),
    (2, (200.0, 200.0)),
    (3, (404.0, 100.0)),
    (4, (500.0, 100.0)),
)


def _features(spark, sf_dir, keep=("event_id",)) -> DataFrame:
    return feature_rows(log_records(spark, sf_dir), keep)


def _indexed(spark, sf_dir, keep=("event_id",)) -> DataFrame:
    rows = written(_features(spark, sf_dir, keep), "feature-rows")
    return features.index_columns(rows, ("request", "verb", "city_name"), "event_id")


def clustered_rows(spark, sf_dir) -> DataFrame:
    rows = _indexed(spark, sf_dir, keep=("event_id", "timestamp"))
    found = models.assign_nearest(rows, ("response", "requestIndex"), CENTRES)
    return written(found, "clustered")


def _labelled(spark, sf_dir) -> DataFrame:
    return models.labelled(clustered_rows(spark, sf_dir), FOUR, keep=("event_id",))


def _scores(spark, sf_dir, kind, inputs, **options) -> DataFrame:
    _, scored = models.fit_and_score(_labelled(spark, sf_dir), kind, inputs, "event_id", **options)
    return scored


def _rounded(df: DataFrame, digits: int, *columns) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources and sinks ------------------------------------------------------------


def parse_lines(spark, sf_dir):
    seconds = F.unix_timestamp(parse_log_time(F.col("timestamp")))
    return (
        parsed_logs(spark, sf_dir)
        .withColumn("event_seconds", seconds)
        .drop("user_id", "message")
    )


def log_file_lines(spark, sf_dir):
    path = new_path(spark, "log-files")
    log_lines(spark, sf_dir).select("message").write.text(path)
    lines = logs.log_file_source(spark, path)
    return (
        parse_combined_log(lines)
        .groupBy("type", "verb", "response")
        .agg(F.count("*").alias("n"), F.sum(F.col("bytes").cast("bigint")).alias("bytes"))
    )


def json_file_records(spark, sf_dir):
    path = new_path(spark, "json-files")
    log_records(spark, sf_dir).drop("event_id", "user_id", "parsed", "rawrequest").write.json(path)
    records = logs.json_file_source(spark, path)
    return records.groupBy("verb", F.col("geoip.city_name").alias("city_name")).agg(
        F.count("*").alias("n"), F.sum(F.col("bytes").cast("bigint")).alias("bytes")
    )


def _messages(events: DataFrame) -> DataFrame:
    """Events as ``(event_id, key, value)``; those of type error are not JSON."""
    parsed = parse_combined_log(with_log_line(events))
    fields = [f.name for f in LOG_SCHEMA.fields if f.name in parsed.columns]
    record = F.to_json(F.struct(*fields))
    value = F.when(F.col("event_type") == "error", F.concat(F.lit("{bad "), record))
    return parsed.select(
        "event_id", F.col("clientip").alias("key"), value.otherwise(record).alias("value")
    )


def json_strings(spark, sf_dir):
    messages = _messages(spread_small_input(table(spark, sf_dir, "events")))
    decoded = logs.decode_messages(messages)
    return decoded.select(
        "event_id",
        F.col("_record.verb").alias("verb"),
        F.col("_record.request").alias("request"),
        "reason",
    )


def broker_payload(spark, sf_dir):
    fields = parsed_logs(spark, sf_dir).select("event_id", "clientip", "verb", "response")
    return kafka.kafka_payload(fields, key="event_id")


def _with_precision(spark, sf_dir):
    rows = clustered_rows(spark, sf_dir)
    train, test = hash_split(rows, "event_id")
    common = train.groupBy("clusters").agg(F.count("*").alias("n"))
    guess = common.agg(F.max_by("clusters", F.struct("n", -F.col("clusters"))).alias("c"))
    pairs = test.select(
        F.col("clusters").cast("double").alias("label"),
        guess.scalar().cast("double").alias("prediction"),
    )
    score = metrics.scalar_metrics(pairs).select(F.round("precision", 6).alias("precision"))
    return rules.attach_metric(rows, score)


def cluster_csv_files(spark, sf_dir):
    path = new_path(spark, "cluster-csv")
    day = F.date_trunc("day", parse_log_time(F.col("timestamp")))
    files.cluster_csv_sink(files.with_minute(_with_precision(spark, sf_dir), day), path)
    schema = "verb string, clusters int, precision double, minute string"
    back = logs.csv_rule_source(spark, path, schema)
    return back.groupBy("minute", "verb", "clusters", "precision").agg(F.count("*").alias("n"))


def rule_text_files(spark, sf_dir):
    path = new_path(spark, "rule-text")
    made = rules.generate_rules(_with_precision(spark, sf_dir), ("verb", "response"))
    files.rule_text_sink(made.withColumn("minute", F.lit("all")), path)
    return spark.read.text(path).select(F.col("value").alias("rule"))


def synthetic_log_profile(spark, sf_dir):
    ids = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    lines = synthetic.line_columns(ids, "2024-01-01 00:00:00", seed=11, anomalies=True)
    return (
        parse_combined_log(lines.select("id", "message"))
        .groupBy("parsed", "verb", "response")
        .agg(F.count("*").alias("n"))
    )


# --- projections and counts --------------------------------------------------------


def log_feature_rows(spark, sf_dir):
    return _features(spark, sf_dir)


def accumulate_union(spark, sf_dir):
    parsed = parsed_logs(spark, sf_dir)
    history = parsed.filter("verb = 'GET'").select("event_id", "verb", "response")
    batch = parsed.filter("verb <> 'GET'").select("request", "event_id", "verb")
    return accumulate(history, batch)


def row_counts(spark, sf_dir):
    """Both counts in one pass, which parses every line once."""
    rows = response_to_double(project_log_features(log_records(spark, sf_dir)))
    return rows.agg(F.count("*").alias("n_logs"), F.count_if(is_complete(rows)).alias("n_kept"))


def category_frequency(spark, sf_dir):
    return features.frequencies(_features(spark, sf_dir), ("request", "verb", "city_name"))


def csv_line_cells(spark, sf_dir):
    """Customers as CSV lines of cleaned values, split again."""
    cleaned = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat_ws(
            ",", strip_commas(F.concat("c_name", F.lit(","), "c_mktsegment")), "c_nationkey"
        ).alias("line"),
    )
    cells = split_csv_line(F.col("line"))
    return cleaned.select(
        "c_custkey", cells[0].alias("name"), cells[1].alias("nation"), F.size(cells).alias("n_cells")
    )


# --- features ------------------------------------------------------------------------


def _string_index(column):
    def query(spark, sf_dir):
        rows = written(_features(spark, sf_dir).select("event_id", column), "indexed")
        return features.string_index(rows, column, features.INDEX_COLUMNS[column], "event_id")

    return query


def _array_columns(df, vector, stem, size, digits=6):
    values = vector_to_array(vector)
    return df.withColumns({f"{stem}{i}": F.round(values[i], digits) for i in range(size)})


def feature_table_four(spark, sf_dir):
    made = features.assemble(_indexed(spark, sf_dir), "four")
    made = _array_columns(made, "features", "f", 4)
    made = _array_columns(made, "features_normalized", "u", 4)
    return made.select("event_id", *[f"f{i}" for i in range(4)], *[f"u{i}" for i in range(4)])


def feature_table_verb(spark, sf_dir):
    rows = written(_features(spark, sf_dir).select("event_id", "verb"), "verbs")
    made = features.feature_table(rows, "verb", "event_id")
    made = _array_columns(made, "features", "f", 1)
    return _array_columns(made, "features_normalized", "u", 1).select(
        "event_id", "verb", "f0", "u0"
    )


def feature_table_lat_long(spark, sf_dir):
    made = features.feature_table(_features(spark, sf_dir), "lat_long", "event_id")
    return _array_columns(made, "latLong", "p", 2).select("event_id", "p0", "p1")


def feature_model_verb(spark, sf_dir):
    rows = written(_features(spark, sf_dir).select("event_id", "verb"), "verbs")
    made = features.ml_feature_model(rows, "verb").transform(rows)
    return _array_columns(made, "features", "f", 1).select("event_id", "verb", "verbIndex", "f0")


def standard_scale(spark, sf_dir):
    made = features.standard_scale(features.assemble(_indexed(spark, sf_dir), "four"))
    made = _array_columns(made, "featuresScaled", "s", 4)
    return made.select("event_id", *[f"s{i}" for i in range(4)])


def one_hot_verb(spark, sf_dir):
    made = features.one_hot(_indexed(spark, sf_dir), "verbIndex", "verbVec")
    return made.select(
        "event_id",
        "verb",
        *[vector_to_array("verbVec")[i].alias(f"v{i}") for i in range(3)],
    )


def vector_index(spark, sf_dir):
    both = models.vectors(_indexed(spark, sf_dir), ("response", "verbIndex"))
    made = _array_columns(features.vector_index(both), "featuresIndexed", "x", 2)
    return made.select("event_id", "x0", "x1")


def request_vectors(spark, sf_dir):
    rows = written(_features(spark, sf_dir).select("event_id", "request"), "requests")
    made = token_vectors.request_vectors(rows, row_id="event_id")
    return made.select("event_id", F.size(vector_to_array("requestWords")).alias("dimensions"))


def request_cooccurrences(spark, sf_dir):
    """How often path segments stand side by side."""
    requests = token_vectors.weighted_requests(_features(spark, sf_dir))
    return token_vectors.cooccurrences(requests)


def request_neighbours(spark, sf_dir):
    """The nearest segments of the most frequent ones, by their vectors."""
    rows = written(_features(spark, sf_dir).select("request"), "requests")
    vectors = token_vectors.token_vectors(token_vectors.weighted_requests(rows))
    return token_vectors.nearest_tokens(vectors).select(
        "word", "rank", "neighbour", F.round("cosine", 6).alias("cosine")
    )


# --- clustering ------------------------------------------------------------------------


def split_assignment(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", is_train(F.col("event_id")).alias("is_train")
    )


def centroids_by_label(spark, sf_dir):
    means = models.group_means(table(spark, sf_dir, "embeddings"), "embedding", "label")
    return means.select("label", "dim", F.round("mean", 6).alias("mean"))


def _label_centres(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return vectors, models.centers_of(models.group_means(vectors, "embedding", "label"), "label")


def assign_nearest(spark, sf_dir):
    vectors, centres = _label_centres(spark, sf_dir)
    return models.assign_nearest(vectors, "embedding", centres).select("vec_id", "clusters")


def lloyd_two_steps(spark, sf_dir):
    vectors, centres = _label_centres(spark, sf_dir)
    return models.lloyd(vectors, "embedding", centres, 2).select("vec_id", "clusters")


def _kmeans(spark, sf_dir, inputs):
    rows = written(_indexed(spark, sf_dir), "indexed")
    return rows, models.fit_kmeans(rows, inputs)


def kmeans_verb(spark, sf_dir):
    rows, found = _kmeans(spark, sf_dir, ("verbIndex",))
    return found.assign(rows).select("event_id", "verb", "clusters")


def kmeans_four(spark, sf_dir):
    rows, found = _kmeans(spark, sf_dir, FOUR)
    return found.assign(rows).select("event_id", "clusters")


def kmeans_centers(spark, sf_dir):
    _, found = _kmeans(spark, sf_dir, ("verbIndex",))
    return found.centers(spark).select("clusters", F.col("center")[0].alias("center"))


# --- regression and classification --------------------------------------------------------


def linreg_simple(spark, sf_dir):
    scored = _scores(spark, sf_dir, "linear", ("verbIndex",), fitIntercept=False)
    return _rounded(scored, 6, "prediction")


def linreg_with_intercept(spark, sf_dir):
    scored = _scores(spark, sf_dir, "linear", ("requestIndex",), fitIntercept=True)
    return _rounded(scored, 6, "prediction")


def linreg_complex(spark, sf_dir):
    scored = _scores(spark, sf_dir, "linear", FOUR, normalized=True, fitIntercept=True)
    return _rounded(scored, 6, "prediction")


def linreg_elastic_net(spark, sf_dir):
    return _scores(spark, sf_dir, "elastic_net", FOUR)


def _sgd(spark, sf_dir, scale, **options):
    train, test = hash_split(_labelled(spark, sf_dir), "event_id")
    weights = models.linear_sgd(train, ("verbIndex",), **options)
    scored = models.predict_linear(test, ("verbIndex",), weights)
    return scored.select(
        "event_id", "label", F.round(F.col("prediction") * scale, 6).alias("prediction")
    )


def linreg_sgd(spark, sf_dir):
    """Default step and stopping rule; predictions in units of 1e-15."""
    return _sgd(spark, sf_dir, 1e15)


def linreg_gd(spark, sf_dir):
    return _sgd(spark, sf_dir, 1.0, step=0.1, tolerance=0.0)


def logreg_simple(spark, sf_dir):
    return _scores(spark, sf_dir, "logistic", ("verbIndex",))


def logreg_complex(spark, sf_dir):
    return _scores(spark, sf_dir, "logistic", FOUR)


def naive_bayes_simple(spark, sf_dir):
    return _scores(spark, sf_dir, "naive_bayes", ("verbIndex",))


def naive_bayes_complex(spark, sf_dir):
    return _scores(spark, sf_dir, "naive_bayes", FOUR)


def naive_bayes_model(spark, sf_dir):
    train, _ = hash_split(_labelled(spark, sf_dir), "event_id")
    return _rounded(
        models.naive_bayes_parameters(train, FOUR), 6, "log_prior", "log_likelihood"
    )


def decision_tree_simple(spark, sf_dir):
    return _scores(spark, sf_dir, "tree", ("verbIndex",))


def decision_tree_complex(spark, sf_dir):
    return _scores(spark, sf_dir, "tree", FOUR)


# --- metrics --------------------------------------------------------------------------------


def _quality_pairs(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(
        "doc_id",
        F.col("quality").cast("double").alias("prediction"),
        F.col("toxic").cast("double").alias("label"),
    )


def metrics_all(spark, sf_dir):
    found = metrics.scalar_metrics(_quality_pairs(spark, sf_dir))
    doubles = [c for c, t in found.dtypes if t == "double"]
    return _rounded(found, 9, *doubles)


def metrics_by_class(spark, sf_dir):
    found = metrics.class_metrics(_quality_pairs(spark, sf_dir))
    return _rounded(found, 9, "precision", "recall", "f_measure")


def metrics_weighted(spark, sf_dir):
    found = metrics.weighted_metrics(_quality_pairs(spark, sf_dir))
    return _rounded(found, 9, *found.columns)


def classifier_evaluator(spark, sf_dir):
    pairs = _quality_pairs(spark, sf_dir)
    return metrics.weighted_metrics(pairs).select(
        F.round("accuracy", 9).alias("accuracy"),
        F.round("weighted_precision", 9).alias("precision"),
        F.round("weighted_recall", 9).alias("recall"),
    )


def correct_predictions(spark, sf_dir):
    return metrics.correct_predictions(_quality_pairs(spark, sf_dir))


def wrong_predictions(spark, sf_dir):
    return metrics.wrong_predictions(_quality_pairs(spark, sf_dir))


def _value_scores(spark, sf_dir):
    is_error = F.when(F.col("event_type") == "error", 1.0).otherwise(0.0)
    return table(spark, sf_dir, "events").select(
        F.col("value").alias("prediction"), is_error.alias("label")
    )


def roc_curve(spark, sf_dir):
    return _rounded(metrics.roc_curve(_value_scores(spark, sf_dir)), 9, "fpr", "tpr")


def auc(spark, sf_dir):
    return _rounded(metrics.area_under_roc(_value_scores(spark, sf_dir)), 9, "auc")


# --- rules -----------------------------------------------------------------------------------


def rules_text(spark, sf_dir):
    made = rules.generate_rules(
        _with_precision(spark, sf_dir), ("verb", "response", "requestIndex")
    )
    return made.select("rule", "support")


def rules_per_row(spark, sf_dir):
    made = rules.generate_rules(_with_precision(spark, sf_dir), distinct=False, row_id="event_id")
    ordered = rules.order_by_metric(made, ties=("verb", "clusters", "event_id"))
    return ordered.select("event_id", "rule")


def _confident_rules(spark, sf_dir, threshold):
    """Rules scored by their own confidence, the share of the cluster among their rows."""
    counts = clustered_rows(spark, sf_dir).groupBy("verb", "response", "clusters").agg(
        F.count("*").alias("n")
    )
    both = counts.groupBy("verb", "response").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("clusters", "n")).alias("c")
    )
    scored = both.select("verb", "response", "total", F.inline("c")).withColumn(
        "precision", F.round(F.col("n") / F.col("total"), 6)
    )
    return rules.generate_rules(scored, ("verb", "response"), threshold=threshold, weight="n")


def rules_filtered(spark, sf_dir):
    """Rules that hold for half of their rows or more."""
    return _confident_rules(spark, sf_dir, 0.5).select("rule", "support")


def rules_in_order(spark, sf_dir):
    """All rules with their place in the order of their scores."""
    made = _confident_rules(spark, sf_dir, rules.RULE_THRESHOLD)
    ranked = rules.ranked_by_metric(made, ties=("verb", "response", "clusters"))
    return ranked.select("rank", "rule", "precision")


def minute_rule_support(spark, sf_dir):
    minute = minute_stamp(parse_log_time(F.col("timestamp")))
    stamped = _with_precision(spark, sf_dir).withColumn("minute", minute)
    made = rules.generate_rules(stamped, by=("minute",))
    return made.select("minute", "rule", "support")


def log_rules(spark, sf_dir):
    """Records to rules with the logistic classifier."""
    analysis = analyse_logs(log_records(spark, sf_dir), "event_id")
    return analysis.rules(("verb",)).select("verb", "clusters", "precision", "support", "rule")


def log_rules_tree(spark, sf_dir):
    analysis = analyse_logs(log_records(spark, sf_dir), "event_id", model="tree")
    return analysis.rules(("verb",)).select("rule", "support")


def log_rules_four(spark, sf_dir):
    analysis = analyse_logs(log_records(spark, sf_dir), "event_id", preset="four")
    made = analysis.rules(("verb", "response", "requestIndex"))
    return made.select("rule", "support")


# --- JSON -------------------------------------------------------------------------------------

_NESTED = """concat('{"z":{"b":', event_id, ',"c":null},"d":[', user_id, ',[', event_id % 7,
 ',3],{"e":"', event_type, '","g":{"h":true}}],"f":"x,', user_id, '","em":[],"y":{"f":"w"}}')"""
_DOCUMENT = f"""CASE WHEN event_type = 'error' THEN concat('{{bad ', props)
 WHEN event_type = 'signup' THEN concat('[', props, ',', {_NESTED}, ']')
 WHEN event_type = 'view' THEN props
 ELSE {_NESTED} END"""


def _documents(spark, sf_dir):
    events = spread_small_input(table(spark, sf_dir, "events"))
    return events.select("event_id", F.expr(_DOCUMENT).alias("document"))


def _flat(spark, sf_dir):
    return jsonflat.flatten_json(_documents(spark, sf_dir), "event_id", "document")


def json_flat_long(spark, sf_dir):
    return jsonflat.flat_long(_flat(spark, sf_dir)[0])


def json_collisions(spark, sf_dir):
    return _flat(spark, sf_dir)[0].select("event_id", "element", "collisions")


def json_quarantine(spark, sf_dir):
    return _flat(spark, sf_dir)[1]


def json_flat_wide(spark, sf_dir):
    return jsonflat.flat_wide(written(_flat(spark, sf_dir)[0], "flat"))


def json_csv_lines(spark, sf_dir):
    return jsonflat.csv_lines(written(_flat(spark, sf_dir)[0], "flat"), "event_id")


def json_csv_files(spark, sf_dir):
    path = new_path(spark, "flat-csv")
    files.json_to_csv(_documents(spark, sf_dir), "event_id", "document", path)
    back = spark.read.option("header", True).csv(path)
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in back.columns])


# --- enrichment ---------------------------------------------------------------------------------


def geoip_enrich(spark, sf_dir):
    made = enrich.geoip_enrich(
        parsed_logs(spark, sf_dir), address_ranges(spark, sf_dir), "event_id"
    )
    return made.select("event_id", "clientip", "geo_city")


def _gazetteer(spark, sf_dir):
    """Nations as addresses; those of one region are spelled in another way."""
    return table(spark, sf_dir, "nation").selectExpr(
        "CASE WHEN n_regionkey = 2 THEN lower(n_name) ELSE n_name END AS address",
        "CAST(n_nationkey + 0.5 AS DOUBLE) AS lat",
        "CAST(n_nationkey * 2 AS DOUBLE) AS lng",
    )


def geocode_lookup(spark, sf_dir):
    rows = event_places(spark, sf_dir).select("event_id", F.col("geoip.city_name").alias("address"))
    return enrich.geocode_lookup(rows, _gazetteer(spark, sf_dir), "event_id")


def geocode_sql_functions(spark, sf_dir):
    enrich.register_geocode_functions(_gazetteer(spark, sf_dir))
    logs.register_view(event_places(spark, sf_dir), "geocoded_logs")
    return spark.sql(
        """SELECT event_id, geocodeCityCountryLat(geoip.city_name) AS lat,
             geocodeCityCountryLng(geoip.city_name) AS lng FROM geocoded_logs"""
    )


# --- windows and streams ---------------------------------------------------------------------------


def _logged_messages(spark, sf_dir):
    """A message log of the events, and the table of a stream that read it.

    Writer and reader run twice over one checkpoint each: events of odd ids come second.
    """
    log, state, table_path, rest, read_state, source = (
        new_path(spark, n)
        for n in ("log", "log-state", "log-table", "log-rest", "log-read", "log-source")
    )
    events = table(spark, sf_dir, "events")
    for i in range(2):
        events.filter(F.col("event_id") % 2 == i).write.parquet(f"{source}/{i}")
        stream = spark.readStream.schema(events.schema).parquet(f"{source}/*")
        records = parse_combined_log(with_log_line(stream).select("event_id", "message"))
        message_log.message_log_sink(
            records.select("event_id", "verb", "request", "response"), log, state, key="event_id"
        ).trigger(availableNow=True).start().awaitTermination()
        ingest.ingest_logs(
            message_log.message_log_source(spark, log), table_path, rest, read_state,
            keep=("key", "row_id"), available_now=True,
        ).awaitTermination()
    kept = [StructField(n, StringType()) for n in ("key", "row_id")]
    return log, ingest.read_ingested(spark, table_path, keep_fields=kept)


def message_log_records(spark, sf_dir):
    """Every event once, through a message log and a restart of both its ends."""
    read = _logged_messages(spark, sf_dir)[1]
    return read.groupBy(
        F.col("key").cast("bigint").alias("event_id"), "verb", "request", "response"
    ).agg(F.count("*").alias("times"), F.count_distinct("row_id").alias("places"))


def message_log_offsets(spark, sf_dir):
    """Messages and offsets of each partition of the log."""
    stored = message_log.read_messages(spark, _logged_messages(spark, sf_dir)[0])
    return stored.groupBy("topic", "partition").agg(
        F.count("*").alias("n"),
        F.count_distinct("offset").alias("places"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def _window_text(df):
    stamp = "yyyy-MM-dd HH:mm:ss"
    return df.select(
        F.date_format("window_start", stamp).alias("window_start"),
        F.date_format("window_end", stamp).alias("window_end"),
        "event_type",
        "n",
    )


def window_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "event_type")
    return _window_text(windows.window_counts(events, ("event_type",)))


def minute_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "event_type")
    return _window_text(windows.minute_counts(events, ("event_type",)))


def stream_window_counts(spark, sf_dir):
    events = stream_table(spark, sf_dir, "events").select("ts", "event_type")
    counts = windows.window_counts(events, ("event_type",))
    path = new_path(spark, "windows")
    query = windows.write_window_updates(
        counts, path, new_path(spark, "windows-state"), available_now=True
    )
    query.awaitTermination()
    return _window_text(windows.latest_windows(spark, path, counts.schema, ("event_type",)))


def _delayed_parts(events, parts=4):
    """Events in order of time, cut in four; every tenth comes one part too late."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    bounds = events.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    on_time = F.expr("CAST(0 AS BIGINT)")
    if bounds["low"] is not None:
        on_time = F.floor((at - bounds["low"]) * parts / (bounds["high"] - bounds["low"] + 1))
    delay = F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    placed = events.withColumn("part", F.least(F.lit(parts - 1), on_time + delay))
    return [placed.filter(F.col("part") == i).drop("part") for i in range(parts)]


def stream_late_rows(spark, sf_dir):
    """Counts per minute and the rows behind the watermark: together all events."""
    path, late, state, source = (
        new_path(spark, n) for n in ("counted", "late", "late-state", "late-source")
    )
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    for i, part in enumerate(_delayed_parts(events)):
        # One run of the query, and so one batch, for each part.
        part.write.parquet(f"{source}/{i}")
        stream = spark.readStream.schema(events.schema).parquet(f"{source}/*")
        windows.write_windows_and_late_rows(
            stream, path, late, state, ("event_type",), window="1 minute", slide="1 minute",
            available_now=True,
        ).awaitTermination()
    kind = [events.schema["event_type"]]
    counted = windows.summed_windows(spark, path, kind).select(
        "window_start", "event_type", "n", F.lit("counted").alias("kind")
    )
    behind = (
        spark.read.parquet(late)
        .groupBy(F.date_trunc("minute", "ts").alias("window_start"), "event_type")
        .agg(F.count("*").alias("n"))
        .withColumn("kind", F.lit(windows.TOO_LATE))
    )
    minute = F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("minute")
    return counted.unionByName(behind).select(minute, "event_type", "kind", "n")


def _ingested_counts(spark, sf_dir, runs):
    """Counts after that many queries, each with its own checkpoint, wrote one table."""
    messages = _messages(stream_table(spark, sf_dir, "events"))
    good, bad = new_path(spark, "logs"), new_path(spark, "quarantine")
    for _ in range(runs):
        query = ingest.ingest_logs(
            messages, good, bad, new_path(spark, "ingest-state"), available_now=True
        )
        query.awaitTermination()
    table_rows = ingest.read_ingested(spark, good)
    bad_rows = spark.read.schema("value string, reason string").parquet(bad)
    return (
        table_rows.select("verb", F.lit(None).cast("string").alias("reason"))
        .unionByName(bad_rows.select(F.lit(None).cast("string").alias("verb"), "reason"))
        .groupBy("verb", "reason")
        .agg(F.count("*").alias("n"))
    )


def stream_ingest(spark, sf_dir):
    return _ingested_counts(spark, sf_dir, 1)


def stream_ingest_twice(spark, sf_dir):
    return _ingested_counts(spark, sf_dir, 2)


def stream_minute_rules(spark, sf_dir):
    path = new_path(spark, "minute-rules")
    query = minute_rules.minute_rules(
        stream_log_records(spark, sf_dir),
        "event_id",
        new_path(spark, "minute-csv"),
        path,
        new_path(spark, "minute-state"),
        available_now=True,
    )
    query.awaitTermination()
    return spark.read.text(path).select(F.col("value").alias("rule"))


def raw_line_rules(spark, sf_dir):
    """Raw lines to rules: files, parsing, address ranges, clusters, classifier."""
    path = new_path(spark, "raw-lines")
    spread_small_input(raw_lines(table(spark, sf_dir, "events"))).write.parquet(path)
    lines = spark.read.parquet(path)
    records = enrich.located_records(lines, location_ranges(spark, sf_dir), "event_id")
    analysis = analyse_logs(records, "event_id")
    return analysis.rules(("verb",)).select("verb", "clusters", "precision", "support", "rule")


def raw_line_counts(spark, sf_dir):
    """What becomes of raw lines: whether they match, and whether they have a place."""
    lines = spread_small_input(raw_lines(table(spark, sf_dir, "events")))
    records = enrich.located_records(lines, location_ranges(spark, sf_dir), "event_id")
    return records.groupBy(
        "parsed",
        "verb",
        F.col("geoip.country_name").alias("country_name"),
        F.col("geoip.city_name").alias("city_name"),
    ).agg(F.count("*").alias("n"), F.sum(F.col("geoip.location")[0]).alias("longitudes"))


def _stream_raw_lines(spark, sf_dir, **outputs):
    lines = raw_lines(stream_table(spark, sf_dir, "events"))
    ranges = location_ranges(spark, sf_dir)
    paths = [new_path(spark, n) for n in ("raw-csv", "raw-rules", "raw-state")]
    minute_rules.minute_rules(
        enrich.located_records(lines, ranges, "event_id"),
        "event_id",
        *paths,
        available_now=True,
        **outputs,
    ).awaitTermination()
    return paths[1]


def stream_raw_line_rules(spark, sf_dir):
    return spark.read.text(_stream_raw_lines(spark, sf_dir)).select(F.col("value").alias("rule"))


def stream_rule_scores(spark, sf_dir):
    """The scores that the stream writes: test rows, errors and the area under the curve."""
    path = new_path(spark, "raw-metrics")
    _stream_raw_lines(spark, sf_dir, metrics_path=path)
    return spark.read.parquet(path).select("model", "n", "n_correct", "mse", "auc")


QUERIES = {
    "parse_combined_log": parse_lines,
    "log_file_lines": log_file_lines,
    "json_file_records": json_file_records,
    "json_strings_to_table": json_strings,
    "kafka_payload": broker_payload,
    "message_log_records": message_log_records,
    "message_log_offsets": message_log_offsets,
    "cluster_csv_files": cluster_csv_files,
    "rule_text_files": rule_text_files,
    "synthetic_log_profile": synthetic_log_profile,
    "log_feature_rows": log_feature_rows,
    "accumulate_union": accumulate_union,
    "row_counts": row_counts,
    "category_frequency": category_frequency,
    "csv_line_cells": csv_line_cells,
    "string_index_verb": _string_index("verb"),
    "string_index_request": _string_index("request"),
    "string_index_city": _string_index("city_name"),
    "feature_table_four": feature_table_four,
    "feature_table_verb": feature_table_verb,
    "feature_table_lat_long": feature_table_lat_long,
    "feature_model_verb": feature_model_verb,
    "standard_scale": standard_scale,
    "one_hot_verb": one_hot_verb,
    "vector_index": vector_index,
    "request_vectors": request_vectors,
    "request_cooccurrences": request_cooccurrences,
    "request_neighbours": request_neighbours,
    "split_assignment": split_assignment,
    "centroids_by_label": centroids_by_label,
    "assign_nearest": assign_nearest,
    "lloyd_two_steps": lloyd_two_steps,
    "kmeans_verb": kmeans_verb,
    "kmeans_four": kmeans_four,
    "kmeans_centers": kmeans_centers,
    "linreg_simple": linreg_simple,
    "linreg_with_intercept": linreg_with_intercept,
    "linreg_complex": linreg_complex,
    "linreg_elastic_net": linreg_elastic_net,
    "linreg_sgd": linreg_sgd,
    "linreg_gd": linreg_gd,
    "logreg_simple": logreg_simple,
    "logreg_complex": logreg_complex,
    "naive_bayes_simple": naive_bayes_simple,
    "naive_bayes_complex": naive_bayes_complex,
    "naive_bayes_model": naive_bayes_model,
    "decision_tree_simple": decision_tree_simple,
    "decision_tree_complex": decision_tree_complex,
    "metrics_all": metrics_all,
    "metrics_by_class": metrics_by_class,
    "metrics_weighted": metrics_weighted,
    "classifier_evaluator": classifier_evaluator,
    "correct_predictions": correct_predictions,
    "wrong_predictions": wrong_predictions,
    "roc_curve": roc_curve,
    "auc": auc,
    "rules_text": rules_text,
    "rules_per_row": rules_per_row,
    "rules_filtered": rules_filtered,
    "rules_in_order": rules_in_order,
    "minute_rule_support": minute_rule_support,
    "log_rules": log_rules,
    "log_rules_tree": log_rules_tree,
    "log_rules_four": log_rules_four,
    "json_flat_long": json_flat_long,
    "json_collisions": json_collisions,
    "json_quarantine": json_quarantine,
    "json_flat_wide": json_flat_wide,
    "json_csv_lines": json_csv_lines,
    "json_csv_files": json_csv_files,
    "geoip_enrich": geoip_enrich,
    "geocode_lookup": geocode_lookup,
    "geocode_sql_functions": geocode_sql_functions,
    "window_counts": window_counts,
    "minute_counts": minute_counts,
    "stream_window_counts": stream_window_counts,
    "stream_late_rows": stream_late_rows,
    "stream_ingest": stream_ingest,
    "stream_ingest_twice": stream_ingest_twice,
    "stream_minute_rules": stream_minute_rules,
    "raw_line_rules": raw_line_rules,
    "raw_line_counts": raw_line_counts,
    "stream_raw_line_rules": stream_raw_line_rules,
    "stream_rule_scores": stream_rule_scores,
}
