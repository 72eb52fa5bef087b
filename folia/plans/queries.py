"""One query per operator, each over whole tables. Results are flat."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.functions import bin_column, has_field, hash_bucket, json_fields, sanitize
from folia.operators import catalog, changes, documents, models, prep, profile
from folia.plans.bindings import LENGTH_EDGES, LENGTH_LABELS, catalog_tables, change_tables, labelled, table
from folia.session import new_path
from folia.sources import (
    json_lines,
    load_collection,
    read_csv,
    read_documents,
    write_json,
)

# Rows that a document of these tables may hold in one array.
PART_SIZE = 100_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def joined_text(items: Column) -> Column:
    """Sorted array items as one text, with a mark for NULL."""
    return F.concat_ws(",", F.transform(items, lambda x: F.coalesce(x.cast("string"), F.lit("~"))))


# --- catalog reads -------------------------------------------------------


@query
def catalog_listing(spark, sf_dir):
    return catalog.catalog_listing(*catalog_tables(spark, sf_dir))


@query
def catalog_entry(spark, sf_dir):
    return catalog.catalog_entry(*catalog_tables(spark, sf_dir), 40)


@query
def catalog_preview(spark, sf_dir):
    rows = catalog.catalog_listing(*catalog_tables(spark, sf_dir))
    return catalog.first_rows(rows, 3, "book_id", F.col("author").asc_nulls_last())


@query
def catalog_projection(spark, sf_dir):
    rows = catalog.catalog_listing(*catalog_tables(spark, sf_dir))
    return rows.select("book_id", "author", (F.col("inventory") > 0).alias("in_stock"))


@query
def catalog_as_json(spark, sf_dir):
    rows = catalog.catalog_listing(*catalog_tables(spark, sf_dir))
    return catalog.as_json(rows.withColumn("price", F.col("price").cast("decimal(18,2)")))


@query
def book_lookup(spark, sf_dir):
    return catalog.point_lookup(catalog_tables(spark, sf_dir)[0], "book_id", 15)


@query
def orders_by_status(spark, sf_dir):
    return catalog.equals(table(spark, sf_dir, "orders"), o_orderstatus="F").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query
def author_credit_counts(spark, sf_dir):
    _, book_author, authors, _ = catalog_tables(spark, sf_dir)
    named = book_author.join(authors, "author_id", "left")
    return catalog.value_counts(named, ["last_name"], "credits")


# --- documents -----------------------------------------------------------


@query
def order_documents(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "orderkey")
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    docs = documents.embed_many(orders, lines, ["orderkey"], "lines", part_size=PART_SIZE, total="n_lines")
    return docs.select(
        "orderkey",
        "o_totalprice",
        "part",
        "n_lines",
        F.aggregate("lines", F.lit(0.0), lambda s, x: s + x["l_quantity"]).alias("sum_quantity"),
        F.array_min(F.transform("lines", lambda x: x["l_linenumber"])).alias("min_line"),
        F.array_max(F.transform("lines", lambda x: x["l_extendedprice"])).alias("max_price"),
    )


@query
def order_documents_in_parts(spark, sf_dir):
    """The same documents with at most three lines each, so most orders need several."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"))
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    docs = documents.embed_many(orders, lines, ["orderkey"], "lines", total="n_lines", part_size=3)
    return docs.select("orderkey", "part", "n_lines", F.size("lines").cast("long").alias("n_here"))


@query
def embedded_lines_exploded(spark, sf_dir):
    """Embedding in parts and unnesting again gives every line back."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"))
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    fields = ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    docs = documents.embed_many(orders, lines, ["orderkey"], "lines", fields, part_size=3)
    return docs.select("orderkey", F.explode("lines").alias("line")).select("orderkey", "line.*")


@query
def customer_documents(spark, sf_dir):
    """Customers with their orders as an array and their nation as an object."""
    customers = table(spark, sf_dir, "customer").withColumn(
        "nationkey", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_nationkey"))
    )
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    docs = documents.embed_one(
        customers, table(spark, sf_dir, "nation"), "nationkey", "n_nationkey", "nation", ["n_name", "n_regionkey"]
    )
    docs = documents.embed_many(docs, orders, ["c_custkey"], "orders", part_size=PART_SIZE)
    return docs.select(
        "c_custkey",
        F.size("orders").cast("long").alias("n_orders"),
        F.aggregate(
            "orders", F.lit(0).cast("decimal(28,2)"), lambda s, x: (s + x["o_totalprice"].cast("decimal(18,2)")).cast("decimal(28,2)")
        ).cast("double").alias("spent"),
        F.col("nation").isNull().alias("no_nation"),
        F.col("nation.n_name").alias("nation_name"),
        F.col("nation.n_regionkey").alias("nation_region"),
    )


@query
def brand_documents(spark, sf_dir):
    """Parts under their brand, a text key; the parts stay a table of their own."""
    parts = table(spark, sf_dir, "part")
    brands = catalog.distinct_rows(parts, ["p_brand"])
    docs = documents.embed_many(brands, parts, ["p_brand"], "parts", part_size=PART_SIZE)
    return docs.select(
        "p_brand",
        F.size("parts").cast("long").alias("n_parts"),
        F.array_min(F.transform("parts", lambda x: x["p_partkey"])).alias("first_part"),
        F.array_max(F.transform("parts", lambda x: x["p_retailprice"])).alias("max_price"),
    )


def _orders_and_customers(spark, sf_dir):
    """Orders, of which some name a customer that is not there and some name none."""
    priority = F.col("o_orderpriority")
    custkey = F.when(priority == "5-LOW", -F.col("o_custkey")).when(priority != "1-URGENT", F.col("o_custkey"))
    return table(spark, sf_dir, "orders").withColumn("o_custkey", custkey), table(spark, sf_dir, "customer")


@query
def order_links(spark, sf_dir):
    """Orders with the id of their customer's document, where there is one."""
    orders, customers = _orders_and_customers(spark, sf_dir)
    orders = documents.with_document_id(orders.select("o_orderkey", "o_custkey"), "orders", ["o_orderkey"])
    return documents.link(orders, customers, "customers", "o_custkey", "c_custkey", "customer_ref")


@query
def order_part_types(spark, sf_dir):
    """Distinct part types per order through the lines; a missing type stays in the list."""
    lines, parts = _lines_and_parts(spark, sf_dir)
    packed = documents.pack_distinct(lines, parts, ["orderkey"], ["partkey"], "types", ["p_type"], scalar=True, part_size=PART_SIZE)
    docs = documents.attach(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey")), [packed])
    return docs.select("orderkey", F.size("types").cast("long").alias("n_types"), joined_text(F.col("types")).alias("types"))


def _lines_and_parts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnsRenamed(
        {"l_orderkey": "orderkey", "l_partkey": "partkey", "l_suppkey": "suppkey"}
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("partkey"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("p_type"),
        "p_brand",
        "p_size",
    )
    return lines, parts


@query
def order_distinct_types(spark, sf_dir):
    """The same as flat rows: an inner join through the bridge, then distinct."""
    lines, parts = _lines_and_parts(spark, sf_dir)
    return documents.distinct_children(lines, parts, ["orderkey"], ["partkey"], ["p_type"])


@query
def order_all_regions(spark, sf_dir):
    """Orders with lines refer to all regions, which are written once."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"))
    lines, _ = _lines_and_parts(spark, sf_dir)
    return documents.refer_all_when_present(orders, lines, ["orderkey"], "regions")


@query
def shared_regions(spark, sf_dir):
    return documents.shared_rows(table(spark, sf_dir, "region"), "regions", ["r_name", "r_regionkey"])


@query
def order_visit_documents(spark, sf_dir):
    """One document per order with three keyed arrays, a reference to all regions and two links."""
    lines, parts = _lines_and_parts(spark, sf_dir)
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "suppkey")
    orders, customers = _orders_and_customers(spark, sf_dir)
    orders = orders.select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    # Lines meet parts and suppliers once, and all arrays come from one grouping.
    children = lines.select("orderkey", "partkey", "suppkey").join(parts.withColumn("is_part", F.lit(True)), "partkey", "left")
    children = children.join(suppliers.withColumn("is_supplier", F.lit(True)), "suppkey", "left")
    arrays = {
        "types": F.when(F.col("is_part"), F.struct("p_type")),
        "items": F.when(F.col("is_part"), F.struct("p_brand", "p_size")),
        "sellers": F.when(F.col("is_supplier"), F.struct("s_name", "s_nationkey")),
        "line_suppliers": F.struct("suppkey"),
    }
    docs = documents.embed_sets(orders, children, ["orderkey"], arrays, part_size=PART_SIZE)
    first = F.when(F.size("line_suppliers") > 0, F.array_min("line_suppliers")["suppkey"])
    docs = docs.withColumn("supplier", first).withColumn("regions_ref", F.when(F.size("line_suppliers") > 0, documents.all_rows_id("regions")))
    docs = documents.link(docs, customers, "customers", "o_custkey", "c_custkey", "customer_ref")
    docs = documents.link(docs, suppliers.filter("s_acctbal >= 0"), "suppliers", "supplier", "suppkey", "supplier_ref")
    sizes = [F.size(c).cast("long").alias(f"n_{c}") for c in ("types", "items", "sellers")]
    types = joined_text(F.transform("types", lambda x: x["p_type"])).alias("types")
    return sanitize(docs).select("orderkey", *sizes, types, "regions_ref", "customer_ref", "supplier_ref")


def _customers_and_orders(spark, sf_dir):
    orders, customers = _orders_and_customers(spark, sf_dir)
    customers = documents.with_document_id(customers, "customers", ["c_custkey"])
    return customers, documents.link(orders, customers, "customers", "o_custkey", "c_custkey", "customer_ref")


def _history_columns(docs):
    prices = F.transform("history", lambda x: x["o_totalprice"])
    return docs.select(
        F.col("parent_info.c_custkey").alias("c_custkey"),
        "total_children",
        F.size("history").cast("long").alias("n_history"),
        F.array_max(prices).alias("max_price"),
        F.array_min(prices).alias("min_price"),
    )


@query
def customer_histories(spark, sf_dir):
    customers, orders = _customers_and_orders(spark, sf_dir)
    return _history_columns(documents.histories(customers, orders, "_id", "customer_ref", part_size=PART_SIZE))


@query
def customer_history_sample(spark, sf_dir):
    """Histories of the first three customers: the sample report."""
    customers, orders = _customers_and_orders(spark, sf_dir)
    docs = documents.history_sample(customers, orders, "_id", "customer_ref", 3, ["c_custkey"], part_size=PART_SIZE)
    return _history_columns(docs)


@query
def history_sample_json(spark, sf_dir):
    """The sample report written as nested JSON and read back as lines of text."""
    path = new_path(spark, "json")
    customers, orders = _customers_and_orders(spark, sf_dir)
    customers, orders = customers.select("_id", "c_custkey"), orders.select("customer_ref", "o_orderkey")
    write_json(documents.history_sample(customers, orders, "_id", "customer_ref", 3, ["c_custkey"], part_size=PART_SIZE), path)
    return spark.read.text(path).select(F.col("value").alias("document"))


@query
def sanitized_orders(spark, sf_dir):
    """Decimals and dates inside an array of objects come out as doubles and timestamps."""
    nested = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.array(F.struct(F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").cast("decimal(12,2)").alias("paid"))).alias("payments"),
    )
    clean = sanitize(nested)
    return clean.select(
        "o_orderkey",
        "price",
        F.explode("payments").alias("p"),
    ).select("o_orderkey", "price", F.col("p.paid").alias("paid"), F.date_format("p.day", "yyyy-MM-dd HH:mm:ss").alias("paid_at"))


# --- sources and sinks ---------------------------------------------------


@query
def csv_round_trip(spark, sf_dir):
    """Orders written as CSV and read with inferred types; empty fields are NULL."""
    path = new_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("custkey"), "o_totalprice", "o_orderpriority"
    )
    orders.write.csv(path, header=True)
    return read_csv(spark, path)


@query
def collection_round_trip(spark, sf_dir):
    """Customers loaded to a collection twice through a hook, and all read back."""
    path = new_path(spark, "collection")

    def hook(df):
        return df.withColumn("balance", F.col("c_acctbal").cast("decimal(12,2)")).drop("c_acctbal")

    customers = table(spark, sf_dir, "customer")
    for _ in range(2):
        load_collection(customers, path, hook, mode="append")
    return read_documents(spark, path).select("c_custkey", "c_nationkey", "c_mktsegment", "balance")


@query
def collection_find(spark, sf_dir):
    """The customers of one nation, found in a collection."""
    path = new_path(spark, "collection")
    load_collection(table(spark, sf_dir, "customer"), path)
    return read_documents(spark, path, where={"c_nationkey": 7}).select("c_custkey", "c_mktsegment")


@query
def json_round_trip(spark, sf_dir):
    """Nested order documents exported as JSON, read back and unnested."""
    path = new_path(spark, "json")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    docs = documents.embed_many(orders, lines, ["orderkey"], "lines", ["l_partkey", "l_quantity"], part_size=PART_SIZE)
    write_json(docs, path)
    back = read_documents(spark, path, format="json", schema=docs.schema)
    return back.select("orderkey", F.explode_outer("lines").alias("x")).groupBy("orderkey").agg(
        F.count("x.l_partkey").alias("n_lines"), F.sum("x.l_quantity").alias("sum_quantity")
    )


@query
def order_json_lines(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"), F.array("o_orderpriority", "o_orderstatus").alias("tags")
    )
    return json_lines(orders, "document")


@query
def row_hook_lengths(spark, sf_dir):
    """A per-batch Python hook over whole texts."""

    def lengths(batches):
        for batch in batches:
            yield batch.assign(n=batch["text"].str.len())[["doc_id", "n"]]

    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    return documents.row_hook(texts, lengths, "doc_id long, n long")


# --- changes -------------------------------------------------------------


@query
def change_outcomes(spark, sf_dir):
    return changes.apply_changes(*change_tables(spark, sf_dir)).outcomes


@query
def change_outcome_counts(spark, sf_dir):
    outcomes = changes.apply_changes(*change_tables(spark, sf_dir)).outcomes
    return catalog.value_counts(outcomes, ["op", "outcome"], "n")


@query
def changed_books(spark, sf_dir):
    return changes.apply_changes(*change_tables(spark, sf_dir)).books


@query
def changed_inventory(spark, sf_dir):
    inventory = changes.apply_changes(*change_tables(spark, sf_dir)).inventory
    return inventory.groupBy("book_id", "quantity").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def changes_with_book(spark, sf_dir):
    books, _, log, _ = change_tables(spark, sf_dir)
    return changes.existing(log, books).select("seq", "key")


@query
def changes_without_book(spark, sf_dir):
    books, _, log, _ = change_tables(spark, sf_dir)
    return changes.missing(log, books).select("seq", "key")


@query
def undeleted_customers(spark, sf_dir):
    """Customers without those that any delete names."""
    _, _, log, _ = change_tables(spark, sf_dir)
    named = log.filter(F.col("op") == changes.DELETE).select(F.col("key").alias("c_custkey")).distinct()
    return changes.delete_keys(table(spark, sf_dir, "customer"), "c_custkey", named)


@query
def inserts_checked(spark, sf_dir):
    books, _, log, _ = change_tables(spark, sf_dir)
    return changes.read_inserts(log, {f.name: f.dataType for f in books.schema})


@query
def event_fields(spark, sf_dir):
    """A JSON body read by whitelist: the known field, an unknown one, and presence."""
    events = table(spark, sf_dir, "events").select("event_id", "props", json_fields("props", ["k", "z"]))
    return events.select(
        "event_id",
        F.col("k").try_cast("int").alias("k"),
        "z",
        has_field("props", "k").alias("has_k"),
        has_field("props", "z").alias("has_z"),
    )


@query
def whitelisted_customers(spark, sf_dir):
    return changes.whitelist(table(spark, sf_dir, "customer"), ["c_custkey", "c_mktsegment", "quantity"])


# --- profiling -----------------------------------------------------------


@query
def discount_counts(spark, sf_dir):
    discount = F.col("l_discount")
    return profile.conditional_counts(
        table(spark, sf_dir, "lineitem"),
        n_zero=discount == 0,
        n_nonzero=discount != 0,
        n_high=discount >= 0.05,
    )


@query
def quality_counts(spark, sf_dir):
    return catalog.value_counts(labelled(spark, sf_dir), ["quality"], "n")


@query
def single_modes(spark, sf_dir):
    """Modes of several columns; most documents have no label, yet NULL is no mode."""
    return prep.modes(labelled(spark, sf_dir), ["quality", "toxic", "lang", "source"])


@query
def top_segment(spark, sf_dir):
    return prep.top_value(table(spark, sf_dir, "customer"), "c_mktsegment", "n")


@query
def tied_modes(spark, sf_dir):
    return prep.all_modes(table(spark, sf_dir, "documents"), "source")


def _quantities(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )


@query
def exact_medians(spark, sf_dir):
    """The exact counterpart of the approximate median: the lower middle value."""
    lines = _quantities(spark, sf_dir)
    rows = lines.agg(F.count("quantity").alias("n"))
    medians = profile.exact_quantiles_of(lines, {"quantity": [0.5], "price": [0.5]}, interpolate=False)
    return rows.select("n", *[F.lit(v[0]).alias(f"median_{c}") for c, v in medians.items()])


@query
def approximate_median_rank(spark, sf_dir):
    """Whether the approximate median of the prices has a rank within the promised error."""
    lines = _quantities(spark, sf_dir)
    median = prep.approximate_medians(lines, ["price"]).first()["price"]
    n, err = F.count("price"), prep.RANK_ERROR
    return lines.agg(
        n.alias("n"),
        (
            (F.count_if(F.col("price") < median) <= (0.5 + err) * n)
            & (F.count_if(F.col("price") <= median) >= (0.5 - err) * n)
        ).alias("within_error"),
    )


@query
def filled_quantities(spark, sf_dir):
    """Missing priorities and order years filled with their modes."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("priority"),
        F.when(F.col("o_orderstatus") != "F", F.year("o_orderdate")).alias("year"),
    )
    return prep.fit_fill_values(orders, ["priority", "year"]).apply(orders)


@query
def median_filled_lines(spark, sf_dir):
    """Small whole quantities: the median of 50 distinct values, filled into an int column."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).cast("int").alias("quantity"), "l_returnflag"
    )
    median = profile.exact_quantiles(lines, "quantity", [0.5], interpolate=False)[0]
    filled = prep.FillValues({"quantity": median}).apply(lines)
    return catalog.value_counts(filled, ["l_returnflag", "quantity"], "n")


def _rounded(df, digits=4):
    return df.select(*[F.round(c, digits).alias(c) if c != "count" else F.col(c) for c in df.columns])


@query
def describe_price(spark, sf_dir):
    return _rounded(profile.describe(table(spark, sf_dir, "orders"), "o_totalprice"))


@query
def describe_nonzero_discount(spark, sf_dir):
    return _rounded(profile.describe(table(spark, sf_dir, "lineitem").filter(F.col("l_discount") != 0), "l_discount"))


@query
def price_quantiles(spark, sf_dir):
    probabilities = [0.01, 0.25, 0.5, 0.9, 0.999]
    values = profile.exact_quantiles(table(spark, sf_dir, "orders"), "o_totalprice", probabilities)
    rows = [(p, round(v, 4)) for p, v in zip(probabilities, values)]
    return spark.createDataFrame(rows, "p double, value double")


@query
def narrowed_quantiles(spark, sf_dir):
    """Quantiles of the line prices found through sketches and exact counts."""
    probabilities = [0.25, 0.5, 0.75]
    lines = table(spark, sf_dir, "lineitem")
    values = profile.exact_quantiles(lines, "l_extendedprice", probabilities, interpolate=False)
    return spark.createDataFrame(list(zip(probabilities, values)), "p double, value double")


@query
def null_counts(spark, sf_dir):
    return profile.null_counts(labelled(spark, sf_dir))


@query
def column_profile(spark, sf_dir):
    return profile.column_profile(labelled(spark, sf_dir))


@query
def length_outliers(spark, sf_dir):
    return profile.outlier_count(table(spark, sf_dir, "documents"), "n_chars")


@query
def price_density(spark, sf_dir):
    rows = profile.density(table(spark, sf_dir, "orders"), "o_totalprice", points=20)
    return rows.select(F.round("x", 3).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density"))


@query
def price_density_binned(spark, sf_dir):
    rows = profile.density(table(spark, sf_dir, "orders"), "o_totalprice", points=20, error=1e-3)
    return rows.select(F.round("x", 3).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density"))


@query
def distinct_sizes(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.nullif("p_size", F.lit(7)).alias("p_size"))
    return profile.sorted_distinct(parts, "p_size")


@query
def binned_balances(spark, sf_dir):
    balance = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", bin_column(balance, [0, 2500, 7500.5], ["Low", "Medium", "High", "Very High"]).alias("bin")
    )


@query
def binned_discounts(spark, sf_dir):
    discount = F.when(F.col("l_returnflag") != "N", F.col("l_discount"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_discount").alias("discount"),
        bin_column(discount, [0.05], ["Low", "High"], special={0: "None"}).alias("bin"),
    )
    return catalog.value_counts(lines, ["discount", "bin"], "n")


# --- models --------------------------------------------------------------

CATEGORICAL, NUMERIC, LABEL = ["lang", "source", "length_bin"], ["toxic"], "quality"


@query
def hash_split_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = models.hash_split(orders, "o_orderkey")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query
def random_split_orders(spark, sf_dir):
    """Both halves of a random split; which row is in which depends on the layout."""
    train, test = models.random_split(table(spark, sf_dir, "orders").select("o_orderkey"))
    return train.unionByName(test)


@query
def split_buckets(spark, sf_dir):
    bucket = hash_bucket("o_orderkey", 10, "s")
    return catalog.value_counts(table(spark, sf_dir, "orders").select(bucket.alias("bucket")), ["bucket"], "n")


@query
def selected_features(spark, sf_dir):
    return prep.select_features(labelled(spark, sf_dir), CATEGORICAL, NUMERIC, LABEL, ["doc_id"])


@query
def string_indexes(spark, sf_dir):
    """Index of each value by falling frequency; a missing label gets the next index."""
    indexed = models.index_columns(labelled(spark, sf_dir), [*CATEGORICAL, LABEL])
    return indexed.select("doc_id", *[f"{c}_idx" for c in [*CATEGORICAL, LABEL]])


@query
def assembled_features(spark, sf_dir):
    docs = labelled(spark, sf_dir, "inner")
    prepared = models.fit_features(docs, CATEGORICAL, NUMERIC, LABEL).transform(docs)
    vector = vector_to_array(models.FEATURES)
    names = models.feature_names(CATEGORICAL, NUMERIC)
    return prepared.select("doc_id", *[vector[i].alias(f"f{i}") for i in range(len(names))])


def _rule_predictions(spark, sf_dir):
    """A fixed rule: long texts are good."""
    return labelled(spark, sf_dir, "inner").withColumn("prediction", F.when(F.col("n_chars") > 2000, 1).otherwise(0))


@query
def evaluator_accuracy(spark, sf_dir):
    """Accuracy of the rule by the evaluator that scores the models."""
    scored = _rule_predictions(spark, sf_dir).select(F.col(LABEL).cast("double"), F.col("prediction").cast("double"))
    return spark.createDataFrame([(round(models.accuracy(scored, LABEL), 10),)], "accuracy double")


@query
def rule_accuracy(spark, sf_dir):
    """Accuracy of the rule per source."""
    scored = _rule_predictions(spark, sf_dir)
    rows = models.accuracy_by(scored, LABEL, "prediction", ["source"])
    return rows.select("source", F.round("accuracy", 10).alias("accuracy"))


@query
def best_source(spark, sf_dir):
    """The source with the best rule accuracy; the first by name wins a tie."""
    return models.best_by(rule_accuracy(spark, sf_dir), "accuracy", "source")


def _split(spark, sf_dir):
    docs = prep.select_features(labelled(spark, sf_dir, "inner"), CATEGORICAL, NUMERIC, LABEL, ["doc_id"])
    return models.hash_split(docs, "doc_id")


@query
def model_scores(spark, sf_dir):
    return models.compare_models(*_split(spark, sf_dir), CATEGORICAL, NUMERIC, LABEL)


@query
def best_model(spark, sf_dir):
    return models.best_by(model_scores(spark, sf_dir), "accuracy", "position")


@query
def logistic_coefficients(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    prepared = models.fit_features(train, CATEGORICAL, NUMERIC, LABEL).transform(train)
    fitted = models.logistic_regression(f"{LABEL}_idx").fit(prepared)
    return models.coefficients(spark, fitted, models.feature_names(CATEGORICAL, NUMERIC))


@query
def tree_predictions(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    prepared = models.fit_features(train, CATEGORICAL, NUMERIC, LABEL)
    fitted = models.decision_tree(f"{LABEL}_idx").fit(prepared.transform(train))
    return fitted.transform(prepared.transform(test)).select("doc_id", f"{LABEL}_idx", "prediction")


# Models whose result has a closed form, on rows where the features tell something.


@query
def logistic_log_odds(spark, sf_dir):
    """One binary feature: the coefficient is the difference of the log-odds."""
    train, _ = _split(spark, sf_dir)
    prepared = models.fit_features(train, [], NUMERIC, LABEL).transform(train)
    fitted = models.logistic_regression(f"{LABEL}_idx").fit(prepared)
    rows = models.coefficients(spark, fitted, models.feature_names([], NUMERIC))
    return rows.select("class", "feature", (F.round("coefficient", 3) + 0.0).alias("coefficient"))


SIGNS = ["is_dear", "is_done", "is_low"]


def _priced_orders(spark, sf_dir):
    """Dear orders are `high`, but for those of low priority, of which the cheap are."""
    dear, low = F.col("o_totalprice") > 150000, F.col("o_orderpriority") == "5-LOW"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dear.cast("int").alias("is_dear"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_done"),
        low.cast("int").alias("is_low"),
        F.when(dear != low, "high").otherwise("plain").alias("level"),
    )
    return models.hash_split(orders, "o_orderkey")


def _stump(label):
    return models.decision_tree(label, depth=1)


def _forest_of_one(label):
    return models.random_forest(label, trees=1, depth=1).setBootstrap(False).setFeatureSubsetStrategy("all")


def _level_predictions(spark, sf_dir, classifier):
    train, test = _priced_orders(spark, sf_dir)
    prepared = models.fit_features(train, [], SIGNS, "level")
    fitted = models.detached(spark, classifier("level_idx").fit(prepared.transform(train)))
    predicted = fitted.transform(prepared.transform(test))
    names = F.array(*[F.lit(x) for x in prepared.stages[-1].labels])
    return predicted.select("o_orderkey", F.get(names, F.col("prediction").cast("int")).alias("predicted"))


@query
def stump_predictions(spark, sf_dir):
    """A tree of one split takes the feature with the best Gini gain."""
    return _level_predictions(spark, sf_dir, _stump)


@query
def single_tree_forest_predictions(spark, sf_dir):
    """A forest of one tree over all rows and features is that tree."""
    return _level_predictions(spark, sf_dir, _forest_of_one)


@query
def signal_model_scores(spark, sf_dir):
    """On one binary feature with signal all three models take the majority of each value."""
    train, test = _priced_orders(spark, sf_dir)
    label = "level_idx"
    three = [("Logistic Regression", models.logistic_regression(label)), ("Decision Tree", _stump(label)), ("Random Forest", _forest_of_one(label))]
    scores = models.compare_models(train, test, [], ["is_dear"], "level", three)
    return scores.select("position", "model", F.round("accuracy", 10).alias("accuracy"), "is_best")


@query
def signal_best_model(spark, sf_dir):
    return models.best_by(signal_model_scores(spark, sf_dir), "accuracy", "position")


@query
def prepared_training_rows(spark, sf_dir):
    """The whole preparation: missing values filled by median and modes, binned, selected, indexed."""
    docs = labelled(spark, sf_dir).withColumn("n_chars", F.when(F.col("source") != "src3", F.col("n_chars")))
    median = profile.exact_quantiles(docs, "n_chars", [0.5], interpolate=False)[0]
    modes = prep.fit_fill_values(docs, ["quality", "toxic"])
    filled = modes.apply(prep.FillValues({"n_chars": median}).apply(docs))
    binned = filled.withColumn("length_bin", bin_column("n_chars", LENGTH_EDGES, LENGTH_LABELS))
    chosen = prep.select_features(binned, CATEGORICAL, NUMERIC, LABEL, ["doc_id"])
    indexed = models.index_columns(chosen, [*CATEGORICAL, LABEL])
    return indexed.select("doc_id", *[f"{c}_idx" for c in CATEGORICAL], *NUMERIC, f"{LABEL}_idx")
