"""The same results in plain SQL, written from the meaning of each operator."""

from __future__ import annotations

_CATALOG = """
books AS (SELECT o_orderkey AS book_id, o_orderpriority AS title, o_orderstatus AS isbn,
                 CAST(year(o_orderdate) AS INTEGER) AS published_year, o_totalprice AS price,
                 o_custkey AS publisher_id FROM orders),
book_author AS (SELECT l_orderkey AS book_id, l_suppkey AS author_id FROM lineitem),
authors AS (SELECT s_suppkey AS author_id, n_name AS first_name,
                   NULLIF(r_name, 'MIDDLE EAST') AS last_name
            FROM supplier JOIN nation ON s_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey),
inventory AS (SELECT l_orderkey AS book_id,
                     CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS INTEGER) END AS quantity
              FROM lineitem),
stock AS (SELECT b.book_id, (SELECT CAST(sum(i.quantity) AS BIGINT) FROM inventory i WHERE i.book_id = b.book_id) AS q FROM books b),
names AS (SELECT author_id, concat_ws('', first_name, ' ', last_name) AS author FROM authors
          WHERE first_name IS NOT NULL AND last_name IS NOT NULL),
times AS (SELECT ba.book_id, n.author, count(*) AS m FROM book_author ba LEFT JOIN names n ON n.author_id = ba.author_id
          GROUP BY ba.book_id, n.author),
listing AS (SELECT b.*, t.author, COALESCE(s.q * COALESCE(t.m, 1), 0) AS inventory
            FROM books b JOIN stock s ON s.book_id = b.book_id LEFT JOIN times t ON t.book_id = b.book_id)
"""

_LABELLED = """
labelled AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
                    CASE WHEN n_chars <= 500 THEN 'Short' WHEN n_chars <= 2000 THEN 'Medium'
                         WHEN n_chars <= 8000 THEN 'Long' ELSE 'Very Long' END AS length_bin
             FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""
_INNER = _LABELLED.replace("LEFT JOIN", "JOIN")

# Every change is decided from scratch: born, first effective delete, outcome.
_CHANGES = """
raw AS (SELECT event_id AS seq, user_id, value,
               CASE WHEN event_type IN ('signup', 'purchase') THEN 'insert'
                    WHEN event_type = 'error' THEN 'delete' ELSE 'update' END AS op,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
log AS (SELECT seq, op, CASE WHEN op <> 'insert' THEN user_id END AS key, k, value FROM raw),
checked AS (SELECT *, k NOT IN (0, 10, 20, 30, 60, 61, 63) AS valid FROM log WHERE op = 'insert'),
ins AS (SELECT seq, k, value,
               (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY seq) AS id
        FROM checked WHERE valid),
born AS (SELECT s_suppkey AS id, CAST(-1 AS BIGINT) AS born FROM supplier
         UNION ALL SELECT id, seq FROM ins),
seen AS (SELECT l.*, b.id IS NOT NULL AND b.born < l.seq AS there
         FROM log l LEFT JOIN born b ON l.key = b.id WHERE l.op <> 'insert'),
died AS (SELECT key, min(seq) AS died FROM seen WHERE op = 'delete' AND there GROUP BY key),
decided AS (SELECT s.seq, s.op, s.key, s.k,
                   CASE WHEN NOT there OR (d.died IS NOT NULL AND s.seq > d.died) THEN 'not_found'
                        WHEN op = 'update' AND (k < 10 OR k = 70) THEN 'invalid'
                        ELSE 'applied' END AS outcome
            FROM seen s LEFT JOIN died d ON s.key = d.key),
outcomes AS (SELECT seq, op, key, outcome, CAST(NULL AS BIGINT) AS new_id FROM decided
             UNION ALL SELECT seq, 'insert', NULL, 'inserted', id FROM ins
             UNION ALL SELECT seq, 'insert', NULL, 'invalid', NULL FROM checked WHERE NOT valid),
gone AS (SELECT key FROM decided WHERE op = 'delete' AND outcome = 'applied'),
latest AS (SELECT key, quantity FROM (
             SELECT key, CASE WHEN k = 50 THEN NULL ELSE k END AS quantity,
                    row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn
             FROM decided WHERE op = 'update' AND outcome = 'applied') WHERE rn = 1)
"""

_TYPES = """
pairs AS (SELECT DISTINCT l_orderkey AS orderkey, NULLIF(p_type, 'PROMO') AS p_type
          FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
# Some orders name a customer that is not there, some name none.
_PLACED = """
placed AS (SELECT o_orderkey, o_totalprice, CASE o_orderpriority WHEN '5-LOW' THEN -o_custkey
                  WHEN '1-URGENT' THEN NULL ELSE o_custkey END AS o_custkey FROM orders)
"""


def _describe(column: str, source: str) -> str:
    quartiles = ", ".join(
        f"round(quantile_cont({column}, {q}), 4) AS {name}"
        for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
    )
    return f"""SELECT count({column}) AS count, round(avg({column}), 4) AS mean,
        round(stddev_samp({column}), 4) AS std, round(min({column}), 4) AS min, {quartiles},
        round(max({column}), 4) AS max FROM {source}"""


def _hashed(key: str) -> str:
    """The bucket 0..99 of a key."""
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 100"


def _index(column: str, source: str = "labelled") -> str:
    """Index by falling frequency, ties by value; NULL gets the next index."""
    text = f"CAST({column} AS VARCHAR)"
    return f"""(SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS i
        FROM (SELECT {text} AS v, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1))"""


def _indexed(columns: list[str], source: str = "labelled") -> str:
    joins = "\n".join(
        f"LEFT JOIN {_index(c, source)} x_{c} ON CAST({source}.{c} AS VARCHAR) = x_{c}.v" for c in columns
    )
    picks = ", ".join(
        f"COALESCE(x_{c}.i, (SELECT CAST(count(DISTINCT {c}) AS DOUBLE) FROM {source})) AS {c}_idx" for c in columns
    )
    return f"indexed AS (SELECT {source}.*, {picks} FROM {source} {joins})"


def _mode(column: str) -> str:
    return f"""(SELECT {column} FROM labelled WHERE {column} IS NOT NULL GROUP BY {column}
        ORDER BY count(*) DESC, {column} LIMIT 1) AS {column}"""


def _density(weighted: str) -> str:
    """Kernel sums over rows (v, w) on 20 points."""
    return f"""WITH s AS (SELECT count(*) AS n, stddev_samp(o_totalprice) AS sd, min(o_totalprice) AS lo,
                   max(o_totalprice) AS hi FROM orders),
      b AS (SELECT *, sd * power(n, -0.2) AS h FROM s),
      weighted AS ({weighted}),
      grid AS (SELECT lo - 3 * h + i * (hi - lo + 6 * h) / 19 AS x, n, h FROM b, range(20) t(i))
      SELECT round(x, 3) AS x,
             round(sum(w * exp(-0.5 * power((x - v) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi())) * 1e6, 6) AS density
      FROM grid, weighted GROUP BY x"""


def _edges(error: float) -> str:
    """Each order's price split between the two bin edges around it."""
    binned = f"SELECT lo, h * sqrt(8 * {error}) AS d, (o_totalprice - lo) / (h * sqrt(8 * {error})) AS b FROM orders, b"
    return f"""SELECT lo + k * d AS v, sum(w) AS w FROM (
        SELECT lo, d, floor(b) AS k, 1 - (b - floor(b)) AS w FROM ({binned})
        UNION ALL SELECT lo, d, floor(b) + 1, b - floor(b) FROM ({binned})) GROUP BY lo, d, k"""


def _columns(rows: list[tuple[str, str]], template: str) -> str:
    picks = " UNION ALL ".join(template.format(c=c, t=t) for c, t in rows)
    return f"WITH {_LABELLED} SELECT * FROM ({picks})"


_LABELLED_TYPES = [
    ("doc_id", "bigint"),
    ("lang", "string"),
    ("source", "string"),
    ("n_chars", "bigint"),
    ("quality", "int"),
    ("toxic", "int"),
    ("length_bin", "string"),
]

_PRICED = f"""
priced AS (SELECT o_orderkey, CAST(o_totalprice > 150000 AS INTEGER) AS is_dear, CAST(o_orderstatus = 'F' AS INTEGER) AS is_done,
                  CAST(o_orderpriority = '5-LOW' AS INTEGER) AS is_low,
                  CASE WHEN (o_totalprice > 150000) <> (o_orderpriority = '5-LOW') THEN 'high' ELSE 'plain' END AS level,
                  {_hashed('o_orderkey')} < 80 AS trains FROM orders)
"""
# The Gini impurity that is left after each possible split; the least wins.
_STUMP = f"""WITH {_PRICED},
    long AS (SELECT o_orderkey, trains, level, f, v FROM priced
             UNPIVOT (v FOR f IN (is_dear, is_done, is_low))),
    sides AS (SELECT f, v, count(*) AS n, avg(CAST(level = 'high' AS INTEGER)) AS p FROM long WHERE trains GROUP BY f, v),
    best AS (SELECT f FROM sides GROUP BY f ORDER BY sum(n * 2 * p * (1 - p)) LIMIT 1)
    SELECT o_orderkey, CASE WHEN p > 0.5 THEN 'high' ELSE 'plain' END AS predicted
    FROM long JOIN best USING (f) JOIN sides USING (f, v) WHERE NOT trains"""
_SCORES = f"""{_PRICED},
    majority AS (SELECT is_dear, avg(CAST(level = 'high' AS INTEGER)) > 0.5 AS high FROM priced WHERE trains GROUP BY is_dear),
    score AS (SELECT round(avg(CAST((level = 'high') = high AS INTEGER)), 10) AS accuracy
              FROM priced JOIN majority USING (is_dear) WHERE NOT trains),
    scores AS (SELECT CAST(position AS INTEGER) AS position, model, accuracy FROM score,
               (VALUES (0, 'Logistic Regression'), (1, 'Decision Tree'), (2, 'Random Forest')) t(position, model))
"""

_LINES_TOTAL = """
SELECT o_orderkey AS orderkey, o_totalprice, CAST(0 AS BIGINT) AS part, count(l_orderkey) AS n_lines,
       COALESCE(sum(l_quantity), 0.0) AS sum_quantity, min(l_linenumber) AS min_line,
       max(l_extendedprice) AS max_price
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_totalprice
"""

ORACLE: dict[str, str] = {
    "catalog_listing": f"WITH {_CATALOG} SELECT * FROM listing",
    "catalog_entry": f"WITH {_CATALOG} SELECT * FROM listing WHERE book_id = 40 ORDER BY author NULLS LAST LIMIT 1",
    "catalog_preview": f"WITH {_CATALOG} SELECT * FROM listing ORDER BY book_id, author NULLS LAST LIMIT 3",
    "catalog_projection": f"WITH {_CATALOG} SELECT book_id, author, inventory > 0 AS in_stock FROM listing",
    "catalog_as_json": f"""WITH {_CATALOG}
        SELECT '{{"book_id":' || book_id || ',"title":"' || title || '","isbn":"' || isbn
               || '","published_year":' || published_year || ',"price":' || CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR)
               || ',"publisher_id":' || publisher_id || COALESCE(',"author":"' || author || '"', '')
               || ',"inventory":' || inventory || '}}' AS document FROM listing""",
    "book_lookup": f"WITH {_CATALOG} SELECT * FROM books WHERE book_id = 15",
    "orders_by_status": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
    "author_credit_counts": f"""WITH {_CATALOG} SELECT last_name, count(*) AS credits
        FROM book_author ba LEFT JOIN authors a ON ba.author_id = a.author_id GROUP BY last_name""",
    "order_documents": _LINES_TOTAL,
    "order_documents_in_parts": """
        WITH counted AS (SELECT o_orderkey AS orderkey, count(l_orderkey) AS n
                         FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey)
        SELECT orderkey, CAST(part AS BIGINT) AS part, n AS n_lines,
               CAST(least(3, n - 3 * part) AS BIGINT) AS n_here
        FROM counted, LATERAL (SELECT unnest(range(greatest(CAST(ceil(n / 3.0) AS BIGINT), 1))) AS part)""",
    "embedded_lines_exploded": """SELECT l_orderkey AS orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "customer_documents": """
        WITH spent AS (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS s
                       FROM orders GROUP BY o_custkey)
        SELECT c_custkey, COALESCE(n, 0) AS n_orders, COALESCE(s, 0.0) AS spent, n_nationkey IS NULL AS no_nation,
               n_name AS nation_name, n_regionkey AS nation_region
        FROM customer LEFT JOIN spent ON c_custkey = o_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey AND c_mktsegment <> 'MACHINERY'""",
    "brand_documents": """SELECT p_brand, count(*) AS n_parts, min(p_partkey) AS first_part,
        max(p_retailprice) AS max_price FROM part GROUP BY p_brand""",
    "order_links": f"""WITH {_PLACED}
        SELECT sha256('orders|' || CAST(o_orderkey AS VARCHAR)) AS _id, o_orderkey, o_custkey,
               CASE WHEN c_custkey IS NOT NULL THEN sha256('customers|' || CAST(o_custkey AS VARCHAR)) END AS customer_ref
        FROM placed LEFT JOIN customer ON o_custkey = c_custkey""",
    "order_part_types": f"""WITH {_TYPES}
        SELECT o_orderkey AS orderkey, count(pairs.orderkey) AS n_types,
               COALESCE(string_agg(COALESCE(p_type, '~'), ',' ORDER BY p_type NULLS FIRST)
                        FILTER (WHERE pairs.orderkey IS NOT NULL), '') AS types
        FROM orders LEFT JOIN pairs ON o_orderkey = pairs.orderkey GROUP BY o_orderkey""",
    "order_distinct_types": f"WITH {_TYPES} SELECT * FROM pairs",
    "order_all_regions": """SELECT o_orderkey AS orderkey,
        CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN sha256('regions|all') END AS regions_ref FROM orders""",
    "shared_regions": "SELECT DISTINCT sha256('regions|all') AS _id, r_name, r_regionkey FROM region",
    "order_visit_documents": f"""WITH {_TYPES}, {_PLACED},
        types AS (SELECT orderkey, count(*) AS n, string_agg(COALESCE(p_type, '~'), ',' ORDER BY p_type NULLS FIRST) AS t
                  FROM pairs GROUP BY orderkey),
        items AS (SELECT l_orderkey, count(DISTINCT (p_brand, p_size)) AS n
                  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
        sellers AS (SELECT l_orderkey, count(DISTINCT (s_name, s_nationkey)) AS n
                    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey),
        firsts AS (SELECT l_orderkey, min(l_suppkey) AS s FROM lineitem GROUP BY l_orderkey)
        SELECT o_orderkey AS orderkey, COALESCE(types.n, 0) AS n_types, COALESCE(items.n, 0) AS n_items,
               COALESCE(sellers.n, 0) AS n_sellers, COALESCE(t, '') AS types,
               CASE WHEN firsts.s IS NOT NULL THEN sha256('regions|all') END AS regions_ref,
               CASE WHEN c_custkey IS NOT NULL THEN sha256('customers|' || CAST(o_custkey AS VARCHAR)) END AS customer_ref,
               CASE WHEN s_suppkey IS NOT NULL THEN sha256('suppliers|' || CAST(s_suppkey AS VARCHAR)) END AS supplier_ref
        FROM placed LEFT JOIN types ON o_orderkey = types.orderkey
        LEFT JOIN items ON o_orderkey = items.l_orderkey
        LEFT JOIN sellers ON o_orderkey = sellers.l_orderkey
        LEFT JOIN firsts ON o_orderkey = firsts.l_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN supplier ON firsts.s = s_suppkey AND s_acctbal >= 0""",
    "customer_histories": f"""WITH {_PLACED}
        SELECT c_custkey, count(o_orderkey) AS total_children, count(o_orderkey) AS n_history,
               max(o_totalprice) AS max_price, min(o_totalprice) AS min_price
        FROM customer LEFT JOIN placed ON c_custkey = o_custkey GROUP BY c_custkey""",
    "customer_history_sample": f"""WITH {_PLACED}
        SELECT c_custkey, count(o_orderkey) AS total_children, count(o_orderkey) AS n_history,
               max(o_totalprice) AS max_price, min(o_totalprice) AS min_price
        FROM (SELECT * FROM customer ORDER BY c_custkey LIMIT 3) k LEFT JOIN placed ON c_custkey = o_custkey
        GROUP BY c_custkey""",
    "history_sample_json": f"""WITH {_PLACED}, firsts AS (SELECT c_custkey, sha256('customers|' || CAST(c_custkey AS VARCHAR)) AS id
                      FROM customer ORDER BY c_custkey LIMIT 3)
        SELECT '{{"parent_info":{{"_id":"' || id || '","c_custkey":' || c_custkey || '}},"part":0,"total_children":' || count(o_orderkey)
               || ',"history":[' || COALESCE(string_agg('{{"customer_ref":"' || id || '","o_orderkey":' || o_orderkey || '}}', ','
                  ORDER BY o_orderkey) FILTER (WHERE o_orderkey IS NOT NULL), '') || ']}}' AS document
        FROM firsts LEFT JOIN placed ON c_custkey = o_custkey GROUP BY id, c_custkey""",
    "sanitized_orders": """SELECT o_orderkey, o_totalprice AS price, o_totalprice AS paid,
        strftime(date_trunc('day', o_orderdate), '%Y-%m-%d %H:%M:%S') AS paid_at FROM orders""",
    "csv_round_trip": """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey,
        CAST(CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS INTEGER) AS custkey,
        o_totalprice, o_orderpriority FROM orders""",
    "collection_round_trip": "SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal AS balance FROM customer, range(2)",
    "collection_find": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_nationkey = 7",
    "json_round_trip": """SELECT o_orderkey AS orderkey, count(l_partkey) AS n_lines, sum(l_quantity) AS sum_quantity
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""",
    "order_json_lines": """SELECT '{"o_orderkey":' || o_orderkey
        || CASE WHEN o_orderstatus = 'F' THEN '' ELSE ',"status":"' || o_orderstatus || '"' END
        || ',"tags":["' || o_orderpriority || '","' || o_orderstatus || '"]}' AS document FROM orders""",
    "row_hook_lengths": "SELECT doc_id, CAST(length(text) AS BIGINT) AS n FROM documents",
    "change_outcomes": f"WITH {_CHANGES} SELECT * FROM outcomes",
    "change_outcome_counts": f"WITH {_CHANGES} SELECT op, outcome, count(*) AS n FROM outcomes GROUP BY op, outcome",
    "changed_books": f"""WITH {_CHANGES}, everything AS (
        SELECT s_suppkey AS book_id, s_name AS title, 'none' AS isbn, CAST(2000 AS INTEGER) AS published_year,
               s_acctbal AS price, s_nationkey AS publisher_id FROM supplier
        UNION ALL SELECT id, 'Book ' || CAST(seq AS VARCHAR), CAST(seq AS VARCHAR), k + 1990, CASE WHEN k = 62 THEN 0.0 ELSE value END,
                         CASE WHEN k <> 40 THEN k END FROM ins)
        SELECT * FROM everything WHERE book_id NOT IN (SELECT key FROM gone)""",
    "changed_inventory": f"""WITH {_CHANGES}
        SELECT l_suppkey AS book_id,
               CASE WHEN key IS NOT NULL THEN quantity ELSE CAST(l_quantity AS INTEGER) END AS quantity,
               count(*) AS n_rows
        FROM lineitem LEFT JOIN latest ON l_suppkey = key GROUP BY 1, 2""",
    "changes_with_book": f"WITH {_CHANGES} SELECT seq, key FROM log WHERE key IN (SELECT s_suppkey FROM supplier)",
    "changes_without_book": f"""WITH {_CHANGES} SELECT seq, key FROM log
        WHERE key IS NULL OR key NOT IN (SELECT s_suppkey FROM supplier)""",
    "undeleted_customers": f"""WITH {_CHANGES} SELECT * FROM customer
        WHERE c_custkey NOT IN (SELECT key FROM log WHERE op = 'delete')""",
    "inserts_checked": f"""WITH {_CHANGES}
        SELECT seq, CASE k WHEN 0 THEN '' WHEN 60 THEN 'false' WHEN 63 THEN '0' ELSE 'Book ' || CAST(seq AS VARCHAR) END AS title,
               CASE WHEN k = 61 THEN '[]' WHEN k <> 20 THEN CAST(seq AS VARCHAR) END AS isbn,
               CASE WHEN k <> 30 THEN k + 1990 END AS published_year,
               CASE WHEN k IN (10, 62) THEN 0.0 ELSE value END AS price,
               CASE WHEN k <> 40 THEN k END AS publisher_id, valid FROM checked""",
    "event_fields": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
        CAST(NULL AS VARCHAR) AS z, TRUE AS has_k, FALSE AS has_z FROM events""",
    "whitelisted_customers": "SELECT c_custkey, c_mktsegment FROM customer",
    "discount_counts": """SELECT count(*) FILTER (WHERE l_discount = 0) AS n_zero,
        count(*) FILTER (WHERE l_discount <> 0) AS n_nonzero,
        count(*) FILTER (WHERE l_discount >= 0.05) AS n_high FROM lineitem""",
    "quality_counts": f"WITH {_LABELLED} SELECT quality, count(*) AS n FROM labelled GROUP BY quality",
    "single_modes": f"WITH {_LABELLED} SELECT {', '.join(_mode(c) for c in ('quality', 'toxic', 'lang', 'source'))}",
    "top_segment": """SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment
        ORDER BY n DESC, c_mktsegment LIMIT 1""",
    "tied_modes": """SELECT source FROM (SELECT source, rank() OVER (ORDER BY count(*) DESC) AS r
        FROM documents WHERE source IS NOT NULL GROUP BY source) WHERE r = 1""",
    "exact_medians": """SELECT count(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS n,
        quantile_disc(CASE WHEN l_returnflag <> 'R' THEN l_quantity END, 0.5) AS median_quantity,
        quantile_disc(l_extendedprice, 0.5) AS median_price FROM lineitem""",
    # Any value of a rank within the error: the two that bound it are on either side of the middle.
    "approximate_median_rank": """WITH ranked AS (SELECT l_extendedprice AS v, count(*) OVER (ORDER BY l_extendedprice) AS upto,
               count(*) OVER () AS n FROM lineitem)
        SELECT max(n) AS n, min(v) FILTER (WHERE upto >= (0.5 - 0.0001) * n) <= min(v) FILTER (WHERE upto >= (0.5 + 0.0001) * n)
               AS within_error FROM ranked""",
    "filled_quantities": """
        WITH src AS (SELECT o_orderkey, NULLIF(o_orderpriority, '2-HIGH') AS priority,
                            CASE WHEN o_orderstatus <> 'F' THEN CAST(year(o_orderdate) AS INTEGER) END AS year FROM orders)
        SELECT o_orderkey,
               COALESCE(priority, (SELECT priority FROM src WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS priority,
               COALESCE(year, (SELECT year FROM src WHERE year IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS year
        FROM src""",
    "median_filled_lines": """
        WITH src AS (SELECT l_returnflag, CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) END AS q FROM lineitem)
        SELECT l_returnflag, COALESCE(q, (SELECT quantile_disc(q, 0.5) FROM src)) AS quantity, count(*) AS n
        FROM src GROUP BY 1, 2""",
    "describe_price": _describe("o_totalprice", "orders"),
    "describe_nonzero_discount": _describe("l_discount", "lineitem WHERE l_discount <> 0"),
    "price_quantiles": " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(o_totalprice, {p}), 4) AS value FROM orders"
        for p in (0.01, 0.25, 0.5, 0.9, 0.999)
    ),
    "narrowed_quantiles": " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS p, quantile_disc(l_extendedprice, {p}) AS value FROM lineitem"
        for p in (0.25, 0.5, 0.75)
    ),
    "null_counts": _columns(
        _LABELLED_TYPES,
        "SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM labelled",
    ),
    "column_profile": _columns(
        _LABELLED_TYPES, "SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM labelled"
    ),
    "length_outliers": """
        WITH q AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM documents)
        SELECT max(q3 + 1.5 * (q3 - q1)) AS fence, count(*) FILTER (WHERE n_chars >= q3 + 1.5 * (q3 - q1)) AS outliers
        FROM documents, q""",
    "price_density": _density("SELECT o_totalprice AS v, 1 AS w FROM orders"),
    "price_density_binned": _density(_edges(1e-3)),
    "distinct_sizes": "SELECT DISTINCT NULLIF(p_size, 7) AS p_size FROM part",
    "binned_balances": """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Very High'
        WHEN c_acctbal <= 0 THEN 'Low' WHEN c_acctbal <= 2500 THEN 'Medium'
        WHEN c_acctbal <= 7500.5 THEN 'High' ELSE 'Very High' END AS bin FROM customer""",
    "binned_discounts": """SELECT l_discount AS discount, CASE WHEN l_returnflag = 'N' THEN 'High'
        WHEN l_discount = 0 THEN 'None' WHEN l_discount <= 0.05 THEN 'Low' ELSE 'High' END AS bin, count(*) AS n
        FROM lineitem GROUP BY 1, 2""",
    "hash_split_orders": """SELECT o_orderkey,
        CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
             THEN 'train' ELSE 'test' END AS side FROM orders""",
    "split_buckets": """SELECT CAST('0x' || substr(md5('s' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 10 AS bucket,
        count(*) AS n FROM orders GROUP BY 1""",
    "selected_features": f"WITH {_LABELLED} SELECT doc_id, lang, source, length_bin, toxic, quality FROM labelled",
    "string_indexes": f"""WITH {_LABELLED}, {_indexed(['lang', 'source', 'length_bin', 'quality'])}
        SELECT doc_id, lang_idx, source_idx, length_bin_idx, quality_idx FROM indexed""",
    "assembled_features": f"""WITH {_INNER}, {_indexed(['lang', 'source', 'length_bin'])}
        SELECT doc_id, lang_idx AS f0, source_idx AS f1, length_bin_idx AS f2, CAST(toxic AS DOUBLE) AS f3 FROM indexed""",
    "rule_accuracy": f"""WITH {_INNER}
        SELECT source, round(avg(CASE WHEN quality = CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END), 10) AS accuracy
        FROM labelled GROUP BY source""",
    "evaluator_accuracy": f"""WITH {_INNER}
        SELECT round(avg(CASE WHEN quality = CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END), 10) AS accuracy
        FROM labelled""",
    "random_split_orders": "SELECT o_orderkey FROM orders",
    "best_source": f"""WITH {_INNER}
        SELECT source, round(avg(CASE WHEN quality = CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END), 10) AS accuracy
        FROM labelled GROUP BY source ORDER BY accuracy DESC, source LIMIT 1""",
    "logistic_log_odds": f"""WITH {_INNER}, train AS (SELECT * FROM labelled WHERE {_hashed('doc_id')} < 80),
        classes AS (SELECT quality, row_number() OVER (ORDER BY count(*) DESC, CAST(quality AS VARCHAR)) - 1 AS c
                    FROM train GROUP BY quality),
        odds AS (SELECT toxic, ln(count(*) FILTER (WHERE c = 1) / count(*) FILTER (WHERE c = 0)) AS o
                 FROM train JOIN classes USING (quality) GROUP BY toxic)
        SELECT CAST(1 AS INTEGER) AS class, feature, round(v, 3) + 0.0 AS coefficient FROM (
            SELECT 'toxic' AS feature, max(o) FILTER (WHERE toxic = 1) - max(o) FILTER (WHERE toxic = 0) AS v FROM odds
            UNION ALL SELECT '(intercept)', max(o) FILTER (WHERE toxic = 0) FROM odds)""",
    "stump_predictions": _STUMP,
    "single_tree_forest_predictions": _STUMP,
    "signal_model_scores": f"WITH {_SCORES} SELECT position, model, accuracy, position = 0 AS is_best FROM scores",
    "signal_best_model": f"WITH {_SCORES} SELECT position, model, accuracy, TRUE AS is_best FROM scores WHERE position = 0",
    "prepared_training_rows": f"""WITH {_LABELLED},
        holes AS (SELECT doc_id, lang, source, quality, toxic, CASE WHEN source <> 'src3' THEN n_chars END AS n_chars FROM labelled),
        fill AS (SELECT quantile_disc(n_chars, 0.5) AS n, {_mode('quality')}, {_mode('toxic')} FROM holes),
        whole AS (SELECT h.doc_id, h.lang, h.source, COALESCE(h.quality, f.quality) AS quality, COALESCE(h.toxic, f.toxic) AS toxic,
                         COALESCE(h.n_chars, f.n) AS n_chars FROM holes h, fill f),
        binned AS (SELECT *, CASE WHEN n_chars <= 500 THEN 'Short' WHEN n_chars <= 2000 THEN 'Medium'
                                  WHEN n_chars <= 8000 THEN 'Long' ELSE 'Very Long' END AS length_bin FROM whole),
        {_indexed(['lang', 'source', 'length_bin', 'quality'], 'binned')}
        SELECT doc_id, lang_idx, source_idx, length_bin_idx, toxic, quality_idx FROM indexed""",
}
