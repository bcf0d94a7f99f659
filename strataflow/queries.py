"""The operators as queries over the given tables, with equal SQL where SQL can say it.

Each query takes the session and a folder of Parquet tables and reads those tables whole.
Queries that test a sink write below the scratch folder and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.columns import quoted
from strataflow.functions import column, complete_rows, decode_json, encode_json, number, sanitize_names
from strataflow.operators import (
    LinearClassifier,
    Registry,
    accuracy,
    fit,
    fit_category_table,
    fit_logistic,
    fit_table_logistic,
    hash_bucket,
    hash_split,
    join_column,
    join_on_keys,
    load_preparation,
    merge_category_tables,
    save_preparation,
    sparse_features,
    split_target,
    to_vectors,
    transform,
)
from strataflow.plans import (
    build_features,
    export_training_set,
    feature_rows,
    gold_by_join,
    gold_in_place,
    ingest_csv,
    labelled_features,
    labelled_vectors,
    save_training_set,
    score_by_join,
    score_in_place,
    train,
    training_set,
)
from strataflow.sources import (
    append,
    create_database,
    create_table,
    create_table_like,
    export_csv,
    overwrite,
    publish,
    read_csv,
    read_messages,
    read_table,
    scratch_path,
    write_messages,
)
from strataflow.spec import FeatureSpec, Layers, TableFormat
from strataflow.streaming import LayerStream, SparseLayerStream, for_each_batch, stream_id, to_table

STREAM_SECONDS = 900

LANGS = ("de", "en", "es", "fr")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
STATUSES = ("F", "O", "P")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SOURCES = tuple(sorted(f"src{i}" for i in range(20)))

DOCUMENTS = FeatureSpec(("doc_id", "source"), ("lang",), ("n_chars",), "quality")
ORDERS = FeatureSpec(("o_orderkey",), ("o_orderstatus", "o_orderpriority"), ("o_totalprice",))
EVENTS = FeatureSpec(("event_id",), ("event_type",), ("value",))
EVENT_FIELDS = ("event_id", "user_id", "event_type", "value", "props")

CUSTOMERS = FeatureSpec(("key",), ("c_mktsegment",), ("c_acctbal",))
FILE_BYTES = 256 << 20
"""Of a table's files, what goes to one CSV file that is read in ranges."""

SMALL_ROWS = 50
"""A size at which the joins of the given tables take the way of large ones."""

CUSTOMER_SCORER = LinearClassifier("class", ("c_mktsegment_BUILDING", "c_acctbal"), (0, 1), ((-0.5, 2.0),), (-0.75,))
DOCUMENT_SCORER = LinearClassifier("quality", ("lang_en", "n_chars"), (0, 1), ((-0.5, 1.5),), (0.25,))
EVENT_SCORER = LinearClassifier("class", ("event_type_view", "value"), (0, 1), ((0.25, 2.0),), (-0.5,))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_database(spark: SparkSession) -> str:
    """A database of its own for one call, stored in the scratch folder."""
    path = scratch_path(spark, "db")
    name = "check_" + path[-32:].replace("-", "_").replace("/", "_").lower()
    create_database(spark, name, path)
    return name


def documents_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without text, with two columns that have missing values."""
    gaps = {"lang0": F.nullif("lang", F.lit("de")), "src": F.nullif("source", F.lit("src0"))}
    return load(spark, sf_dir, "documents").drop("text").withColumns(gaps)


# sources, sinks, catalog


def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    export_csv(load(spark, sf_dir, "customer"), path)
    rows = read_csv(spark, path)
    return rows.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


def csv_typed(spark, sf_dir):
    path = scratch_path(spark, "csv")
    orders = load(spark, sf_dir, "orders")
    export_csv(orders, path)
    return with_day(read_csv(spark, path, orders.schema))


def with_day(orders: DataFrame) -> DataFrame:
    """The order time as text, as both engines write it."""
    return orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


def csv_documents(spark, sf_dir):
    """Whole documents, with line breaks, quotes and blanks in their texts."""
    path = scratch_path(spark, "csv")
    documents = load(spark, sf_dir, "documents")
    export_csv(documents, path)
    return read_csv(spark, path, documents.schema)


def csv_split(spark, sf_dir):
    """Whole documents from large files that are cut into ranges, whatever line breaks stand in their texts.

    One task writes a file, so there is one for each ``FILE_BYTES`` of the table: a single one as long as it is smaller.
    """
    path = scratch_path(spark, "csv")
    documents = load(spark, sf_dir, "documents")
    size = documents.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0] or 0
    export_csv(documents.coalesce(-(-size // FILE_BYTES) or 1), path)
    return read_csv(spark, path, documents.schema, multi_line="split")


def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "csv")
    export_csv(load(spark, sf_dir, "part"), path)
    return read_csv(spark, path, infer=True).withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


def csv_export(spark, sf_dir):
    """A small result as a single file: documents per language and source."""
    path = scratch_path(spark, "csv")
    counts = load(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    export_csv(counts, path, single_file=True)
    return read_csv(spark, path, counts.schema)


def table_scan(spark, sf_dir):
    table = f"{new_database(spark)}.customer"
    overwrite(load(spark, sf_dir, "customer"), table)
    return read_table(spark, table)


def declared_table(spark, sf_dir):
    table = f"{new_database(spark)}.pairs"
    create_table(spark, table, "k STRING, v STRING")
    part = load(spark, sf_dir, "part")
    append(part.select(F.col("p_partkey").cast("string").alias("k"), F.col("p_name").alias("v")), table)
    return read_table(spark, table)


def table_like_frame(spark, sf_dir):
    table = f"{new_database(spark)}.events"
    events = load(spark, sf_dir, "events")
    create_table_like(events, table)
    append(events, table)
    return read_table(spark, table).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


def overwritten(spark, sf_dir):
    table = f"{new_database(spark)}.t"
    overwrite(load(spark, sf_dir, "part"), table)
    overwrite(load(spark, sf_dir, "customer"), table)
    return read_table(spark, table)


def overwritten_schema(spark, sf_dir):
    table = f"{new_database(spark)}.t"
    customer = load(spark, sf_dir, "customer")
    overwrite(customer.select("c_custkey"), table)
    overwrite(customer, table)
    return read_table(spark, table)


def appended(spark, sf_dir):
    table = f"{new_database(spark)}.part"
    part = load(spark, sf_dir, "part")
    overwrite(part, table)
    append(part.select(*reversed(part.columns)), table)
    return read_table(spark, table)


def json_encoded(spark, sf_dir):
    customer = load(spark, sf_dir, "customer")
    return decode_json(encode_json(customer), customer.columns).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


def json_messages(spark, sf_dir):
    """Messages written to text files and read back as a batch."""
    path = scratch_path(spark, "messages")
    part = load(spark, sf_dir, "part")
    write_messages(part, "text", {}, path)
    return decode_json(spark.read.text(path), part.columns).withColumn("p_retailprice", F.col("p_retailprice").cast("double"))


def global_view(spark, sf_dir):
    view = publish(load(spark, sf_dir, "orders"), "strataflow_orders")
    return with_day(spark.sql(f"SELECT * FROM {view}"))


# projections, filters, scalar functions


def selected(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")


def dropped(spark, sf_dir):
    features, _ = split_target(load(spark, sf_dir, "labels"), "quality")
    return features


def target(spark, sf_dir):
    _, labels = split_target(load(spark, sf_dir, "labels"), "quality")
    return labels


def complete_subset(spark, sf_dir):
    return complete_rows(documents_with_gaps(spark, sf_dir), ["lang0", "src"])


def complete_all(spark, sf_dir):
    return complete_rows(documents_with_gaps(spark, sf_dir))


def sanitized(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    return sanitize_names(part.withColumnsRenamed({"p_partkey": "part key", "p_name": "full part name"}))


def json_decoded(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    # the key goes into the message, as messages have no other columns
    message = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(", "), F.expr("substr(props, 2)"))
    rows = decode_json(events.select(message.cast("binary").alias("value")), ["event_id", "k", "missing"])
    return rows.select(F.col("event_id").cast("bigint"), "k", F.col("missing").cast("string"))


def numbers(spark, sf_dir):
    text = F.col("n_chars").cast("string")
    raw = load(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") == "de", F.concat(F.lit("x"), text)).otherwise(text).alias("chars")
    )
    return raw.select("doc_id", number("chars", raw.schema["chars"].dataType, "null").alias("chars"))


# features

ASSEMBLED = FeatureSpec(("doc_id",), ("lang0", "src"), ("n_chars", "gap"))


def _assembled_input(spark, sf_dir):
    gap = F.when(F.col("lang") != "fr", F.col("doc_id"))
    return documents_with_gaps(spark, sf_dir).withColumn("gap", gap)


def assembled(spark, sf_dir):
    documents = _assembled_input(spark, sf_dir)
    return feature_rows(documents, fit(documents, ASSEMBLED), ASSEMBLED)


def one_hot_fit(spark, sf_dir):
    documents = documents_with_gaps(spark, sf_dir)
    preparation = fit(documents, FeatureSpec(("doc_id",), ("lang0", "src")))
    return preparation.category_table(spark).select("column", "category", "feature")


def one_hot(spark, sf_dir):
    documents = load(spark, sf_dir, "documents")
    spec = FeatureSpec(("doc_id",), ("lang",))
    return feature_rows(documents, fit(documents, spec), spec)


def one_hot_ignore(spark, sf_dir):
    documents = documents_with_gaps(spark, sf_dir).select("doc_id", "lang", F.col("lang0").alias("language"))
    fitted = fit(documents, FeatureSpec(("doc_id",), ("language",)))
    unseen = documents.select("doc_id", F.nullif("lang", F.lit("fr")).alias("language"))
    return transform(unseen, fitted, ["doc_id"], on_unknown="ignore", incomplete="encode")


def names_with_blanks(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    return feature_rows(orders, fit(orders, ORDERS), ORDERS)


def min_max_fit(spark, sf_dir):
    documents = _assembled_input(spark, sf_dir)
    found = fit(documents, FeatureSpec(("doc_id",), (), ("n_chars", "gap")))
    return found.range_table(spark).select("column", "minimum", "maximum")


def min_max(spark, sf_dir):
    documents = load(spark, sf_dir, "documents")
    spec = FeatureSpec(("doc_id",), (), ("n_chars",))
    return feature_rows(documents, fit(documents, spec), spec)


def min_max_apply(spark, sf_dir):
    documents = load(spark, sf_dir, "documents")
    spec = FeatureSpec(("doc_id",), (), ("n_chars",))
    return feature_rows(documents, fit(documents.filter("lang = 'fr'"), spec), spec)


def preparation_roundtrip(spark, sf_dir):
    documents = load(spark, sf_dir, "documents")
    path = scratch_path(spark, "preparation")
    save_preparation(spark, fit(documents, DOCUMENTS), path)
    return feature_rows(documents, load_preparation(spark, path, DOCUMENTS), DOCUMENTS)


def lineitem_features(spark, sf_dir):
    lineitem = load(spark, sf_dir, "lineitem")
    spec = FeatureSpec(
        ("l_orderkey", "l_linenumber"), ("l_returnflag", "l_linestatus"), ("l_quantity", "l_extendedprice")
    )
    return feature_rows(lineitem, fit(lineitem, spec), spec)


def vectors(spark, sf_dir):
    """Place of the two categories in the sparse vector, and its last entry."""
    part = load(spark, sf_dir, "part")
    spec = FeatureSpec(("p_partkey",), ("p_brand", "p_type"), ("p_retailprice",))
    fitted = fit(part, spec)
    array = vector_to_array("features")
    hit = F.filter(
        F.sequence(F.lit(0), F.lit(len(fitted.feature_names) - 2)), lambda i: F.element_at(array, i + 1) == 1.0
    )
    return to_vectors(part, fitted, ["p_partkey"]).select(
        "p_partkey",
        F.element_at(hit, 1).cast("bigint").alias("brand_place"),
        F.element_at(hit, 2).cast("bigint").alias("type_place"),
        F.element_at(array, -1).alias("price"),
    )


def vectors_many(spark, sf_dir):
    """A column in which nearly every row has a category of its own, from a fitted table."""
    part = load(spark, sf_dir, "part")
    spec = FeatureSpec(("p_partkey",), ("p_name", "p_brand"), ("p_retailprice",))
    rows = sparse_features(part, fit_category_table(part, spec, scratch_path(spark, "categories")), ["p_partkey"])
    return _places(rows)


def merged_state(spark, sf_dir):
    """Fitted on small parts, then merged with what large ones have; the first places stay."""
    part = load(spark, sf_dir, "part")
    spec = FeatureSpec(("p_partkey",), ("p_name", "p_brand"), ("p_retailprice",))
    small, large = (
        fit_category_table(part.where(rows), spec, scratch_path(spark, "categories"))
        for rows in ("p_size <= 25", "p_size > 25")
    )
    fitted = merge_category_tables(spark, small, large, scratch_path(spark, "merged"))
    price = F.get("features.values", (F.array_position("features.indices", F.lit(fitted.numbers[0]).cast("bigint")) - 1).cast("int"))
    return sparse_features(part, fitted, ["p_partkey"]).select(
        "p_partkey",
        F.array_join(F.transform("features.indices", lambda i: i.cast("string")), ",").alias("places"),
        F.coalesce(price, F.lit(0.0)).alias("price"),
        F.col("features.size").alias("size"),
    )


def _places(rows: DataFrame) -> DataFrame:
    price = F.when(F.size("features.indices") == 3, F.get("features.values", F.lit(2))).otherwise(0.0)
    return rows.select(
        "p_partkey",
        F.get("features.indices", F.lit(0)).alias("name_place"),
        F.get("features.indices", F.lit(1)).alias("brand_place"),
        price.alias("price"),
        F.col("features.size").alias("size"),
    )


# joins


def label_join(spark, sf_dir):
    return training_set(selected(spark, sf_dir), load(spark, sf_dir, "labels"), "doc_id", "quality")


def label_join_frequent(spark, sf_dir):
    """A fifth of the events shares one key."""
    key = F.when(F.col("event_type") == "view", F.lit(0)).otherwise(F.col("user_id"))
    events = load(spark, sf_dir, "events").withColumn("key", key)
    users = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_mktsegment")
    return join_column(
        events.select("event_id", "key", "value"), users, ["key"], "c_mktsegment", broadcast_rows=SMALL_ROWS
    )


def join_frequent_both(spark, sf_dir):
    """Customers and the suppliers of their nation: each of 25 keys holds some 4 % of both sides."""
    customers = load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey")
    suppliers = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey", "s_acctbal")
    return join_on_keys(customers, suppliers, ["nation"], broadcast_rows=SMALL_ROWS)


def gold_join_frequent(spark, sf_dir):
    """Events with the class predicted for their customer; a fifth of them has the same one."""
    customer = load(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "key")
    table = f"{new_database(spark)}.silver"
    overwrite(feature_rows(customer, fit(customer, CUSTOMERS), CUSTOMERS), table)
    key = F.when(F.col("event_type") == "view", F.lit(1)).otherwise(F.col("user_id"))
    events = load(spark, sf_dir, "events").select("event_id", key.alias("key"), "event_type", "value", "props")
    return gold_by_join(events, read_table(spark, table), CUSTOMER_SCORER, CUSTOMERS, broadcast_rows=SMALL_ROWS)


def labelled(spark, sf_dir):
    documents = selected(spark, sf_dir)
    return labelled_features(
        documents, load(spark, sf_dir, "labels"), fit(documents, DOCUMENTS), DOCUMENTS, "doc_id"
    )


def labelled_as_vectors(spark, sf_dir):
    documents = selected(spark, sf_dir)
    fitted = fit(documents, DOCUMENTS)
    rows = labelled_vectors(documents, load(spark, sf_dir, "labels"), fitted, DOCUMENTS, "doc_id")
    entries = vector_to_array("features")
    return rows.select(
        "doc_id", "source", *[entries[i].alias(name) for i, name in enumerate(fitted.feature_names)], "quality"
    )


def gold_join(spark, sf_dir):
    documents = selected(spark, sf_dir)
    table = f"{new_database(spark)}.silver"
    overwrite(feature_rows(documents, fit(documents, DOCUMENTS), DOCUMENTS), table)
    return gold_by_join(documents, read_table(spark, table), DOCUMENT_SCORER, DOCUMENTS)


def gold_without_join(spark, sf_dir):
    documents = selected(spark, sf_dir)
    return gold_in_place(documents, fit(documents, DOCUMENTS), DOCUMENT_SCORER, DOCUMENTS)


# models


def split(spark, sf_dir):
    documents = selected(spark, sf_dir).withColumn("bucket", hash_bucket(["doc_id"]))
    kept, held_out = hash_split(documents, ["doc_id"])
    parts = kept.withColumn("part", F.lit("train")).union(held_out.withColumn("part", F.lit("test")))
    return parts.select("doc_id", "bucket", "part")


def scored(spark, sf_dir):
    documents = load(spark, sf_dir, "documents")
    rows = feature_rows(documents, fit(documents, DOCUMENTS), DOCUMENTS)
    return DOCUMENT_SCORER.predict(rows).select("doc_id", "quality")


def measured(spark, sf_dir):
    rows = DOCUMENT_SCORER.predict(_labelled(spark, sf_dir), "predicted")
    return accuracy(rows, "quality", "predicted")


def _labelled(spark, sf_dir) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    silver = feature_rows(documents, fit(documents, DOCUMENTS), DOCUMENTS)
    return training_set(silver, load(spark, sf_dir, "labels"), "doc_id", "quality")


def _training_table(spark, sf_dir) -> DataFrame:
    """The labelled rows as a table, since fitting reads them several times."""
    layers = Layers(new_database(spark))
    overwrite(selected(spark, sf_dir), layers.table("bronze"))
    preparation = fit(read_table(spark, layers.table("bronze")), DOCUMENTS)
    table = f"{layers.database}.training"
    save_training_set(spark, layers, load(spark, sf_dir, "labels"), DOCUMENTS, preparation, "doc_id", table)
    return read_table(spark, table)


def _fitted(spark, sf_dir) -> tuple[DataFrame, LinearClassifier]:
    rows = complete_rows(_training_table(spark, sf_dir))
    features = [c for c in rows.columns if c not in (*DOCUMENTS.keys, "quality")]
    return rows, fit_logistic(rows, "quality", features)


def trained(spark, sf_dir):
    """Weight of each feature, the intercept under an empty name."""
    _, model = _fitted(spark, sf_dir)
    weights = [*zip(model.features, model.weights[0]), ("", model.intercepts[0])]
    return spark.createDataFrame(weights, "feature string, weight double")


def optimum(spark, sf_dir):
    """Slope of the objective in each weight, rounded: zero at the only minimum."""
    rows, model = _fitted(spark, sf_dir)
    error = 1.0 / (1.0 + F.exp(-model.margin())) - F.col("quality")
    penalties = [*model.weights[0], 0.0]
    inputs = [*map(column, model.features), F.lit(1.0)]
    slopes = [
        (F.round(F.sum(error * x) + F.lit(w), 2) + F.lit(0.0)).alias(name)
        for x, w, name in zip(inputs, penalties, [*model.features, "intercept"])
    ]
    sums = rows.withColumn("quality", F.col("quality").cast("double")).agg(*slopes)
    return sums.unpivot([], sums.columns, "feature", "slope")


def table_optimum(spark, sf_dir):
    """The same for weights that are a table: parts above size 25 by name, brand and price, and the slope of each category."""
    part = load(spark, sf_dir, "part").withColumn("large", (F.col("p_size") > 25).cast("bigint"))
    fitted = fit_category_table(
        part, FeatureSpec(("p_partkey",), ("p_name", "p_brand"), ("p_retailprice",)), scratch_path(spark, "categories")
    )
    sparse = sparse_features(part, fitted, ["p_name", "p_brand", "large"])
    model = fit_table_logistic(sparse, "large", fitted, scratch_path(spark, "weights"))
    scored = model.margins(sparse, fitted, ["p_name", "p_brand", "large"])
    error = (1.0 / (1.0 + F.exp(-F.col("margin"))) - F.col("large")).alias("error")
    each = F.posexplode(F.array("p_name", "p_brand", F.lit("intercept"))).alias("column", "category")
    slopes = scored.select(error, each).groupBy("column", "category").agg(F.sum("error").alias("slope"))
    weights = fitted.places(spark).join(model.weights(spark), "place").select("column", "category", "weight")
    slope = F.round(F.col("slope") + F.coalesce("weight", F.lit(0.0)), 2) + F.lit(0.0)
    return slopes.join(weights, ["column", "category"], "left").select("column", "category", slope.alias("slope"))


ENGLISH = FeatureSpec(("doc_id",), (), ("english",), "quality")


def _english(spark, sf_dir) -> DataFrame:
    """Labelled documents with one 0/1 feature, so that the best weights are known: log-odds of the two groups."""
    english = F.col("lang").eqNullSafe("en").cast("double").alias("english")
    documents = load(spark, sf_dir, "documents").select("doc_id", english)
    return join_column(documents, load(spark, sf_dir, "labels"), ["doc_id"], "quality")


def closed_form(spark, sf_dir):
    model = fit_logistic(_english(spark, sf_dir), "quality", ["english"], c=1e9)
    rows = [("english", model.weights[0][0]), ("intercept", model.intercepts[0])]
    return spark.createDataFrame(rows, "feature string, weight double").withColumn("weight", F.round("weight", 4))


def _trained_run(spark, sf_dir):
    """A model trained on four fifths of the rows and registered, with its accuracy on the others."""
    database = new_database(spark)
    registry = Registry(database, scratch_path(spark, "models"))
    overwrite(_english(spark, sf_dir), f"{database}.training")
    rows = read_table(spark, f"{database}.training")
    return registry, train(spark, rows, ENGLISH, registry, "quality", "check", c=1e9)


def run_metrics(spark, sf_dir):
    registry, _ = _trained_run(spark, sf_dir)
    return registry.runs(spark).select("experiment", "model", "metric", "value")


def trained_scores(spark, sf_dir):
    """Margins of all documents under the first version of a trained model, read back from the registry."""
    registry, done = _trained_run(spark, sf_dir)
    model = registry.load(spark, "quality", done.version)
    documents = load(spark, sf_dir, "documents").withColumn("english", F.col("lang").eqNullSafe("en").cast("double"))
    return documents.select("doc_id", F.round(model.margin(), 4).alias("margin"), F.lit(done.version).cast("bigint").alias("version"))


def model_versions(spark, sf_dir):
    """A trained first version and a second one with given weights, which scores the documents."""
    registry, _ = _trained_run(spark, sf_dir)
    version = registry.register(spark, DOCUMENT_SCORER, "quality")
    documents = load(spark, sf_dir, "documents")
    rows = feature_rows(documents, fit(documents, DOCUMENTS), DOCUMENTS)
    model = registry.load(spark, "quality", version)
    return model.predict(rows).select("doc_id", "quality", F.lit(version).cast("bigint").alias("version"))


# whole jobs


def _layers(spark) -> Layers:
    return Layers(new_database(spark))


def _ingested(spark, sf_dir) -> Layers:
    path = scratch_path(spark, "csv")
    documents = load(spark, sf_dir, "documents")
    export_csv(documents, path)
    layers = _layers(spark)
    ingest_csv(spark, path, layers, documents.columns)
    return layers


def job_ingest(spark, sf_dir):
    return read_table(spark, _ingested(spark, sf_dir).table("bronze"))


def job_features(spark, sf_dir):
    layers = _ingested(spark, sf_dir)
    build_features(spark, layers, DOCUMENTS)
    return read_table(spark, layers.table("silver"))


def job_training_set(spark, sf_dir):
    layers = _ingested(spark, sf_dir)
    preparation = build_features(spark, layers, DOCUMENTS)
    labels, out = scratch_path(spark, "labels"), scratch_path(spark, "training")
    export_csv(load(spark, sf_dir, "labels"), labels)
    export_training_set(spark, layers, labels, DOCUMENTS, preparation, "doc_id", f"{out}/csv")
    features = ", ".join(f"{quoted(name)} DOUBLE" for name in preparation.feature_names)
    return read_csv(spark, f"{out}/csv", f"doc_id BIGINT, source STRING, {features}, quality INT")


def job_gold(spark, sf_dir, in_place: bool):
    layers = _ingested(spark, sf_dir)
    preparation = build_features(spark, layers, DOCUMENTS)
    registry = Registry(layers.database, scratch_path(spark, "models"))
    registry.create(spark)
    registry.register(spark, DOCUMENT_SCORER, "quality")
    if in_place:
        score_in_place(spark, layers, DOCUMENTS, preparation, registry, "quality")
    else:
        score_by_join(spark, layers, DOCUMENTS, registry, "quality")
    return read_table(spark, layers.table("gold"))


# streams


MESSAGE_FILES = 3


def messages_of(events: DataFrame, fields: tuple[str, ...] = EVENT_FIELDS) -> DataFrame:
    """Rows as a stream of JSON messages: text files, each of which is a micro-batch."""
    spark = events.sparkSession
    path = scratch_path(spark, "messages")
    write_messages(events.select(*fields).repartition(MESSAGE_FILES, fields[0]), "text", {}, path)
    return read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, path)


def _finish(query):
    if not query.awaitTermination(STREAM_SECONDS):
        query.stop()
        raise TimeoutError("the stream did not finish")


def stream_bronze(spark, sf_dir):
    table = f"{new_database(spark)}.bronze"
    raw = decode_json(messages_of(load(spark, sf_dir, "events")), EVENT_FIELDS)
    _finish(to_table(raw, table, scratch_path(spark, "checkpoint"), available_now=True))
    return read_table(spark, table).withColumn("value", F.col("value").cast("double"))


def stream_after_batch(spark, sf_dir):
    """A table loaded by a batch job, streamed into, and appended to again: a third of the events each."""
    table = f"{new_database(spark)}.bronze"
    events = load(spark, sf_dir, "events").select(*EVENT_FIELDS)
    texts = events.select(*(F.col(c).cast("string").alias(c) for c in events.columns))
    third = F.col("event_id") % 3
    overwrite(texts.where(third == 0), table, TableFormat(streamed=True))
    raw = decode_json(messages_of(events.where(third == 1)), EVENT_FIELDS)
    _finish(to_table(raw, table, scratch_path(spark, "checkpoint"), available_now=True))
    append(texts.where(third == 2), table)
    return read_table(spark, table).withColumn("value", F.col("value").cast("double"))


def _layer_stream(spark, sf_dir) -> LayerStream:
    layers = Layers(new_database(spark), fmt=TableFormat(streamed=True))
    return LayerStream(EVENT_FIELDS, EVENTS, layers, fit(load(spark, sf_dir, "events"), EVENTS), EVENT_SCORER)


def stream_layer(spark, sf_dir, layer: str):
    stream = _layer_stream(spark, sf_dir)
    messages = messages_of(load(spark, sf_dir, "events"))
    _finish(stream.start(messages, scratch_path(spark, "checkpoint"), available_now=True))
    rows = read_table(spark, stream.layers.table(layer))
    return rows.withColumn("value", F.col("value").cast("double"))


def stream_quarantine(spark, sf_dir):
    """Events of which each message with an id divisible by seven is cut off, in bronze or in the quarantine."""
    events = load(spark, sf_dir, "events")
    layers = Layers(new_database(spark), fmt=TableFormat(streamed=True))
    stream = LayerStream(EVENT_FIELDS, EVENTS, layers, fit(events, EVENTS), EVENT_SCORER, quarantine="quarantine")
    path = scratch_path(spark, "messages")
    cut = F.concat(F.lit('{"event_id":"'), F.col("event_id").cast("string"))
    broken = events.where("event_id % 7 = 0").select(cut.alias("value"))
    texts = encode_json(events.where("event_id % 7 <> 0"), EVENT_FIELDS).unionByName(broken)
    texts.repartition(MESSAGE_FILES, "value").write.text(path)
    messages = read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, path)
    _finish(stream.start(messages, scratch_path(spark, "checkpoint"), available_now=True))
    bronze = read_table(spark, layers.table("bronze")).select("event_id", F.lit(None).cast("string").alias("message"))
    return bronze.unionByName(read_table(spark, stream.quarantine_table).select(F.lit(None).cast("string").alias("event_id"), "message"))


def stream_silver_many(spark, sf_dir):
    """Streamed parts with a column in which many rows have a category of their own, looked up in the fitted table."""
    part = load(spark, sf_dir, "part")
    fields = ("p_partkey", "p_name", "p_brand", "p_retailprice")
    spec = FeatureSpec(("p_partkey",), ("p_name", "p_brand"), ("p_retailprice",))
    fitted = fit_category_table(part, spec, scratch_path(spark, "categories"))
    layers = Layers(new_database(spark), fmt=TableFormat(streamed=True))
    stream = SparseLayerStream(fields, spec, layers, {0: (fitted, None)})
    _finish(stream.start(messages_of(part, fields), scratch_path(spark, "checkpoint"), available_now=True))
    return _places(read_table(spark, layers.table("silver")).withColumn("p_partkey", F.col("p_partkey").cast("bigint")))


def stream_gold_batches(spark, sf_dir):
    """Three micro-batches, the second of them written twice, then merged into one partition."""
    stream = _layer_stream(spark, sf_dir)
    stream.create_tables(spark)
    checkpoint = scratch_path(spark, "checkpoint")

    def work(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2 if batch_id == 1 else 1):
            stream.write(batch, batch_id, stream_id(checkpoint))

    raw = stream.decode(messages_of(load(spark, sf_dir, "events")))
    _finish(for_each_batch(raw, work, checkpoint, available_now=True))
    stream.compact(spark, checkpoint, MESSAGE_FILES - 2)
    rows = read_table(spark, stream.layers.table("gold"))
    return rows.withColumn("value", F.col("value").cast("double"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the quality that a model trained on the labelled ones predicts for them."""
    documents = selected(spark, sf_dir)
    preparation = fit(documents, DOCUMENTS)
    kept, _ = hash_split(complete_rows(_training_table(spark, sf_dir)), DOCUMENTS.keys)
    model = fit_logistic(kept, "quality", preparation.feature_names)
    return gold_in_place(documents, preparation, model, DOCUMENTS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q_csv_scan": csv_scan,
    "q_csv_typed": csv_typed,
    "q_csv_documents": csv_documents,
    "q_csv_split": csv_split,
    "q_csv_inferred": csv_inferred,
    "q_csv_export": csv_export,
    "q_table_scan": table_scan,
    "q_create_table": declared_table,
    "q_schema_ddl": table_like_frame,
    "q_overwrite": overwritten,
    "q_overwrite_schema": overwritten_schema,
    "q_append": appended,
    "q_json_encode": json_encoded,
    "q_json_messages": json_messages,
    "q_global_view": global_view,
    "q_select": selected,
    "q_drop": dropped,
    "q_target": target,
    "q_dropna_subset": complete_subset,
    "q_dropna_all": complete_all,
    "q_sanitize_names": sanitized,
    "q_json_decode": json_decoded,
    "q_cast_numeric": numbers,
    "q_feature_assemble": assembled,
    "q_onehot_fit": one_hot_fit,
    "q_onehot": one_hot,
    "q_onehot_ignore": one_hot_ignore,
    "q_onehot_names": names_with_blanks,
    "q_minmax_fit": min_max_fit,
    "q_minmax": min_max,
    "q_minmax_apply": min_max_apply,
    "q_prep_roundtrip": preparation_roundtrip,
    "q_features_lineitem": lineitem_features,
    "q_vectors": vectors,
    "q_vectors_many": vectors_many,
    "q_merged_state": merged_state,
    "q_label_join": label_join,
    "q_label_join_frequent": label_join_frequent,
    "q_join_frequent_both": join_frequent_both,
    "q_labelled_features": labelled,
    "q_labelled_vectors": labelled_as_vectors,
    "q_training_table": _training_table,
    "q_gold_join": gold_join,
    "q_gold_join_frequent": gold_join_frequent,
    "q_gold_in_place": gold_without_join,
    "q_split": split,
    "q_score": scored,
    "q_accuracy": measured,
    "q_train": trained,
    "q_train_closed_form": closed_form,
    "q_train_optimum": optimum,
    "q_train_table": table_optimum,
    "q_runs": run_metrics,
    "q_train_scores": trained_scores,
    "q_model_versions": model_versions,
    "q_job_ingest": job_ingest,
    "q_job_features": job_features,
    "q_job_training_set": job_training_set,
    "q_job_gold": partial(job_gold, in_place=False),
    "q_job_gold_in_place": partial(job_gold, in_place=True),
    "q_stream_bronze": stream_bronze,
    "q_stream_after_batch": stream_after_batch,
    "q_stream_silver": partial(stream_layer, layer="silver"),
    "q_stream_gold": partial(stream_layer, layer="gold"),
    "q_stream_silver_many": stream_silver_many,
    "q_stream_gold_batches": stream_gold_batches,
    "q_stream_quarantine": stream_quarantine,
}
