"""Entities, relations, sets, aliases and schema evolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions.fingerprints import attribute_hash
from tidegauge.operators import entities as E
from tidegauge.operators import evolution as V
from tidegauge.operators.aggregates import analyze_part
from tidegauge.plans.spec import GeneratedTrend
from tidegauge.operators.numbering import with_dense_ids
from workload.registry import query
from workload.tables import at

NOW = "2024-02-01 00:00:00"
_NOW = f"TIMESTAMP '{NOW}'"


def number(key: str) -> str:
    """SQL twin of the numbering in md5 order for one text column."""
    return f"row_number() OVER (ORDER BY md5({key}), {key})"


# Names of customers, half of which are not entities yet.
_KNOWN = """known AS (SELECT c_custkey AS id, c_name AS name, TIMESTAMP '2024-01-01 00:00:00' AS created FROM customer WHERE c_acctbal >= 0)"""


def _known(t):
    return t.customer.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), at("2024-01-01 00:00:00").alias("created")
    )


@query(f"""WITH {_KNOWN}, wanted AS (SELECT DISTINCT c_name AS name FROM customer JOIN orders ON o_custkey = c_custkey),
    new AS (SELECT name FROM wanted WHERE name NOT IN (SELECT name FROM known)),
    ids AS (SELECT id, name FROM known UNION ALL SELECT (SELECT max(id) FROM known) + {number('name')}, name FROM new)
    SELECT o_orderkey, ids.id AS entity_id FROM orders JOIN customer ON o_custkey = c_custkey JOIN ids ON ids.name = c_name""")
def resolve_entities(t):
    """Orders as rows that name their entity; unknown names get ids."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_name").alias("entity"))
    everyone = E.with_missing_entities(_known(t), rows.select(F.col("entity").alias("name")), at(NOW))
    return E.resolve_entities(rows, everyone)


@query(f"""WITH {_KNOWN} SELECT (SELECT max(id) FROM known) + {number('c_name')} AS id, c_name AS name, {_NOW} AS created
    FROM customer WHERE c_name NOT IN (SELECT name FROM known)""")
def virtual_entity_update(t):
    view = t.customer.select(F.col("c_name").alias("name"))
    return E.virtual_entity_update(_known(t), view, at(NOW))[0]


@query("""SELECT DISTINCT l_suppkey AS source_id, l_partkey AS target_id FROM lineitem""")
def relation_materialize(t):
    return E.relation_materialize(t.lineitem.select(F.col("l_suppkey").alias("source_id"), F.col("l_partkey").alias("target_id")))


@query("""WITH r AS (SELECT DISTINCT o_custkey AS source_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS target_id FROM orders)
    SELECT 'source' AS side, source_id AS id, count(*) AS partners FROM r GROUP BY 2 HAVING count(*) > 1
    UNION ALL SELECT 'target', target_id, count(*) FROM r GROUP BY 2 HAVING count(*) > 1""")
def relation_cardinality(t):
    edges = t.orders.select(F.col("o_custkey").alias("source_id"), F.substring("o_orderpriority", 1, 1).cast("bigint").alias("target_id"))
    return E.relation_violations(E.relation_materialize(edges), "one-to-one")


# Entity sets: the suppliers of a nation; requested changes name suppliers by nation of the next number.
_SETS = """sets AS (SELECT n_nationkey AS id, n_name AS name, n_name || '_nations_admin' AS fullname, 'nations' AS "group",
    'supplier' AS source_entity_type, 'admin' AS owner, '' AS description, '2024-01-01' AS last_update FROM nation)"""
_REQUEST = """request AS (SELECT n_nationkey AS set_id, s_name AS name FROM nation JOIN supplier ON s_nationkey = (n_nationkey + 1) % 25 WHERE n_regionkey <= 2
    UNION ALL SELECT n_nationkey, 'nobody ' || n_nationkey FROM nation WHERE n_regionkey = 2)"""
_MEMBERS = "members AS (SELECT s_suppkey AS source_id, s_nationkey AS target_id FROM supplier)"


def _sets(t):
    return t.nation.select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.concat(F.col("n_name"), F.lit("_nations_admin")).alias("fullname"), F.lit("nations").alias("group"),
        F.lit("supplier").alias("source_entity_type"), F.lit("admin").alias("owner"), F.lit("").alias("description"),
        F.lit("2024-01-01").alias("last_update"),
    )


def _request(t):
    nation = t.nation.filter(F.col("n_regionkey") <= 2).withColumn("next", (F.col("n_nationkey") + 1) % 25)
    named = nation.join(t.supplier, F.col("next") == F.col("s_nationkey")).select(
        F.col("n_nationkey").alias("set_id"), F.col("s_name").alias("name")
    )
    unknown = t.nation.filter(F.col("n_regionkey") == 2).select(
        F.col("n_nationkey").alias("set_id"), F.concat(F.lit("nobody "), F.col("n_nationkey").cast("string")).alias("name")
    )
    return named.unionByName(unknown)


@query(f"""WITH {_REQUEST} SELECT set_id, name FROM request WHERE name NOT IN (SELECT s_name FROM supplier)""")
def entity_set_guard(t):
    return E.invalid_members(_request(t), t.suppliers)


@query(f"""WITH {_SETS}, wanted AS (SELECT DISTINCT p_brand AS name, 'brands' AS "group", 'part' AS source_entity_type,
        CASE WHEN p_brand < 'Brand#2' THEN 'admin' ELSE 'user' END AS owner, p_brand AS description FROM part
        UNION ALL SELECT name, 'nations', 'supplier', 'admin', 'taken' FROM sets)
    SELECT (SELECT max(id) FROM sets) + row_number() OVER (ORDER BY md5(owner || '|' || name), owner, name) AS id, name,
        name || '_' || "group" || '_' || owner AS fullname, "group", source_entity_type, owner, description, '2024-02-01' AS last_update
    FROM wanted WHERE (owner, name) NOT IN (SELECT (owner, name) FROM sets)""")
def entity_set_create(t):
    brands = t.part.select(
        F.col("p_brand").alias("name"), F.lit("brands").alias("group"), F.lit("part").alias("source_entity_type"),
        F.when(F.col("p_brand") < "Brand#2", "admin").otherwise("user").alias("owner"), F.col("p_brand").alias("description"),
    )
    taken = _sets(t).select("name", "group", "source_entity_type", "owner", F.lit("taken").alias("description"))
    return E.create_sets(_sets(t), brands.unionByName(taken), at(NOW))


_NEW_SETS = f"""{_SETS}, wanted AS (SELECT DISTINCT p_brand AS name, CASE WHEN p_brand < 'Brand#2' THEN 'admin' ELSE 'user' END AS owner FROM part
        UNION ALL SELECT name, 'admin' FROM sets),
    holds AS (SELECT DISTINCT p_brand AS set_name, CASE WHEN p_brand < 'Brand#2' THEN 'admin' ELSE 'user' END AS owner, s_name AS name
        FROM part JOIN supplier ON s_suppkey = p_partkey UNION ALL SELECT name, 'admin', 'nobody' FROM sets
        UNION ALL SELECT 'Brand#11', 'admin', 'nobody ' || n_name FROM nation),
    created AS (SELECT (SELECT max(id) FROM sets) + row_number() OVER (ORDER BY md5(owner || '|' || name), owner, name) AS id, name, owner FROM wanted
        WHERE (owner, name) NOT IN (SELECT (owner, name) FROM sets)
        AND (owner, name) NOT IN (SELECT (owner, set_name) FROM holds WHERE name NOT IN (SELECT s_name FROM supplier)))"""


@query(f"""WITH {_NEW_SETS} SELECT id, c.name AS set_name, owner, s_suppkey AS source_id FROM created c
    LEFT JOIN (SELECT h.set_name, h.owner, s_suppkey FROM holds h JOIN supplier ON s_name = h.name) m ON m.set_name = c.name AND m.owner = c.owner""".replace(
    "SELECT id, c.name AS set_name, owner,", "SELECT id, c.name AS set_name, c.owner AS owner,"))
def entity_set_create_with_members(t):
    """Brands with suppliers as members; sets that exist are left out, and so is a brand of which members are unknown."""
    owner = F.when(F.col("p_brand") < "Brand#2", "admin").otherwise("user").alias("owner")
    brands = t.part.select(
        F.col("p_brand").alias("name"), F.lit("brands").alias("group"), F.lit("part").alias("source_entity_type"), owner,
        F.col("p_brand").alias("description"),
    )
    taken = _sets(t).select("name", "group", "source_entity_type", "owner", F.lit("taken").alias("description"))
    held = t.part.join(t.supplier, F.col("s_suppkey") == F.col("p_partkey")).select(owner, F.col("p_brand").alias("set_name"), F.col("s_name").alias("name"))
    nobody = _sets(t).select("owner", F.col("name").alias("set_name"), F.lit("nobody").alias("name"))
    strangers = t.nation.select(F.lit("admin").alias("owner"), F.lit("Brand#11").alias("set_name"), F.concat(F.lit("nobody "), F.col("n_name")).alias("name"))
    names = held.distinct().unionByName(nobody).unionByName(strangers)
    created, members = E.create_sets_with_members(_sets(t), brands.unionByName(taken), names, t.suppliers, at(NOW))
    sets = created.select("id", F.col("name").alias("set_name"), "owner")
    return sets.join(members, F.col("id") == F.col("target_id"), "left").select("id", "set_name", "owner", "source_id")


@query("""SELECT c_custkey, 1000 + row_number() OVER (ORDER BY md5(c_name), c_name) AS id FROM customer""")
def dense_ids(t):
    """Gap-free numbers that depend on the keys alone."""
    return with_dense_ids(t.customer.select("c_custkey", "c_name"), "c_name", after=1000).select("c_custkey", "id")


@query(f"""WITH {_MEMBERS}, {_REQUEST}, valid AS (SELECT * FROM request WHERE set_id NOT IN
        (SELECT set_id FROM request WHERE name NOT IN (SELECT s_name FROM supplier)))
    SELECT source_id, target_id FROM members WHERE target_id NOT IN (SELECT set_id FROM valid)
    UNION ALL SELECT s_suppkey, set_id FROM valid JOIN supplier ON s_name = name""")
def entity_set_change(t):
    return E.change_members(t.supplier_nation, _request(t), t.suppliers, guarded=True)


@query(f"""WITH {_MEMBERS}, {_REQUEST} SELECT source_id, target_id FROM members UNION SELECT s_suppkey, set_id FROM request JOIN supplier ON s_name = name""")
def entity_set_add(t):
    return E.add_members(t.supplier_nation, _request(t), t.suppliers)


@query(f"""WITH {_MEMBERS}, {_REQUEST}, all_members AS (SELECT source_id, target_id FROM members UNION SELECT s_suppkey, set_id FROM request JOIN supplier ON s_name = name)
    SELECT source_id, target_id FROM all_members EXCEPT SELECT s_suppkey, set_id FROM request JOIN supplier ON s_name = name""")
def entity_set_remove(t):
    wider = E.add_members(t.supplier_nation, _request(t), t.suppliers)
    return E.remove_members(wider, _request(t), t.suppliers)


@query(f"""WITH {_SETS}, {_REQUEST} SELECT * EXCLUDE (last_update),
    CASE WHEN id IN (SELECT set_id FROM request) THEN '2024-02-01' ELSE last_update END AS last_update FROM sets""")
def entity_set_touch(t):
    return E.touch_sets(_sets(t), _request(t), at(NOW))


@query("""SELECT s_nationkey AS set_id, n_name AS set_name, 'admin' AS owner, s_name AS member FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def entity_set_members(t):
    return E.set_members(t.supplier_nation, _sets(t), t.suppliers)


@query("""SELECT DISTINCT l_partkey AS entity_id, p_brand AS alias FROM lineitem JOIN part ON p_partkey = l_partkey""")
def alias_refresh(t):
    sold = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return E.alias_refresh(sold.select(F.col("l_partkey").alias("entity_id"), F.col("p_brand").alias("alias")))


@query("""SELECT c_custkey AS id, c_name AS name, s_name AS alias FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def alias_lookup(t):
    aliases = t.supplier.select(F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("alias"))
    return E.alias_lookup(t.customers, aliases)


@query("""SELECT DISTINCT event_type AS entity_type, 'table' AS origin, props AS name FROM events WHERE user_id < 100
    UNION ALL SELECT DISTINCT p_brand, 'view', p_name FROM part WHERE p_size % 2 = 0""")
def find_trends(t):
    """Trend catalogs: event properties as table trends, part names as view trends."""
    tables = t.events.select(
        F.col("event_type").alias("entity_type"), F.col("props").alias("name"),
        F.when(F.col("user_id") < 100, "15m").otherwise("1h").alias("granularity"),
    )
    views = t.part.select(
        F.col("p_brand").alias("entity_type"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 2 == 0, "15m").otherwise("1d").alias("granularity"),
    )
    return E.find_trends(tables, views)


@query("""SELECT c_name AS name, coalesce(CASE WHEN c_acctbal < 0 THEN 'changed' END, CASE WHEN c_acctbal < 5000 THEN c_mktsegment END, 'none') AS value FROM customer""")
def settings_lookup(t):
    stored = t.customer.filter(F.col("c_acctbal") < 5000).select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("value"))
    changes = t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_name").alias("name"), F.lit("changed").alias("value"))
    wanted = t.customer.select(F.col("c_name").alias("name"), F.lit("none").alias("default"))
    return E.get_settings(E.put_settings(stored, changes), wanted)


# --- schema evolution ----------------------------------------------------------------

_DECLARED = """declared AS (SELECT p_brand AS part, p_name || CASE WHEN p_retailprice > 910 THEN '' ELSE ' new ' END || p_partkey AS trend, CASE WHEN p_size > 10 THEN 'numeric' ELSE 'integer' END AS data_type,
    CASE WHEN p_size > 45 THEN 'MAX' ELSE 'SUM' END AS aggregation FROM part)"""
_ACTUAL = """actual AS (SELECT CASE WHEN p_brand = 'Brand#7' THEN 'Brand#0' ELSE p_brand END AS part,
    p_name || CASE WHEN p_type = 'ECONOMY' THEN ' old ' ELSE '' END || p_partkey AS trend, CASE WHEN p_size > 20 THEN 'numeric' ELSE 'integer' END AS data_type,
    'SUM' AS aggregation FROM part)"""


@query(f"""WITH {_DECLARED}, {_ACTUAL}, j AS (SELECT part, trend, d.data_type AS to_type, a.data_type AS from_type, d.aggregation AS da, a.aggregation AS aa,
        part NOT IN (SELECT part FROM actual) AS fresh FROM declared d FULL JOIN actual a USING (part, trend))
    SELECT part, trend, CASE WHEN fresh THEN 'new part' WHEN from_type IS NULL THEN 'new trend' WHEN to_type IS NULL THEN 'removed trend'
        WHEN to_type <> from_type THEN 'type change' ELSE 'metadata change' END AS change, from_type, to_type
    FROM j WHERE fresh OR from_type IS NULL OR to_type IS NULL OR to_type <> from_type OR da <> aa""")
def schema_diff(t):
    """A trend catalog of parts as declared against the one in use."""
    def trend(condition, word):
        between = F.when(condition, word).otherwise("")
        return F.concat("p_name", between, F.col("p_partkey").cast("string")).alias("trend")

    def typed(limit):
        return F.when(F.col("p_size") > limit, "numeric").otherwise("integer").alias("data_type")

    aggregation = F.when(F.col("p_size") > 45, "MAX").otherwise("SUM").alias("aggregation")
    declared = t.part.select(F.col("p_brand").alias("part"), trend(F.col("p_retailprice") <= 910, " new "), typed(10), aggregation)
    brand = F.when(F.col("p_brand") == "Brand#7", "Brand#0").otherwise(F.col("p_brand")).alias("part")
    actual = t.part.select(brand, trend(F.col("p_type") == "ECONOMY", " old "), typed(20), F.lit("SUM").alias("aggregation"))
    return V.schema_diff(declared, actual)


_FACTS = """SELECT l_orderkey AS entity_id, l_shipdate AS "timestamp", l_linenumber AS line, l_suppkey AS supplier, CAST(l_quantity AS DECIMAL(38,18)) AS quantity"""


def _facts(t):
    """Line items as a stored part with three trends."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("entity_id"), F.col("l_shipdate").alias("timestamp"), F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("supplier"), F.col("l_quantity").cast("decimal(38,18)").alias("quantity"),
    )


@query(f"""{_FACTS}, CAST(NULL AS BIGINT) AS bytes, CAST(NULL AS VARCHAR) AS note, CAST(l_linenumber * 2 AS BIGINT) AS double_line FROM lineitem""")
def add_missing_columns(t):
    declared = {"line": "integer", "bytes": "bigint", "note": "text"}
    return V.add_missing_columns(_facts(t), declared, [GeneratedTrend("double_line", "bigint", "line * 2")])


@query("""SELECT l_orderkey AS entity_id, l_shipdate AS "timestamp", l_suppkey AS supplier FROM lineitem""")
def drop_extra_columns(t):
    return V.drop_extra_columns(_facts(t), {"supplier": "bigint", "bytes": "bigint"})


@query("""SELECT l_orderkey AS entity_id, l_shipdate AS "timestamp", CAST(l_linenumber AS VARCHAR) AS line, CAST(l_suppkey AS INTEGER) AS supplier,
    CAST(l_quantity AS BIGINT) AS quantity FROM lineitem""")
def retype_strong(t):
    return V.retype_strong(_facts(t), {"line": "text", "supplier": "integer", "quantity": "bigint"})


@query("""SELECT l_orderkey AS entity_id, l_shipdate AS "timestamp", CAST(l_linenumber AS VARCHAR) AS line, l_suppkey AS supplier,
    CAST(l_quantity AS DECIMAL(38,18)) AS quantity FROM lineitem""")
def retype_weak(t):
    return V.retype_weak(_facts(t), {"line": "text", "supplier": "integer", "quantity": "bigint"})


@query("""SELECT l_orderkey AS entity_id, l_shipdate AS "timestamp", CAST(l_linenumber AS BIGINT) AS line,
    CAST(l_quantity AS DECIMAL(38,18)) AS quantity, CAST(NULL AS INTEGER) AS bytes,
    'added trends:,bytes,removed trends:,supplier,changed trends:,line' AS report FROM lineitem""")
def apply_changes(t):
    table, report = V.apply_changes(_facts(t), {"line": "bigint", "quantity": "integer", "bytes": "integer"})
    return table.withColumn("report", F.lit(",".join(report.lines())))


@query(f"""SELECT * RENAME (quantity AS amount) FROM ({_FACTS} FROM lineitem)""")
def rename_column(t):
    return V.rename_column(_facts(t), "quantity", "amount")


@query("""SELECT c_custkey AS entity_id, TIMESTAMP '2024-01-01 00:00:00' AS "timestamp", md5(c_name || CAST(c_nationkey AS VARCHAR)) AS hash,
    c_name AS name, c_nationkey AS nation, CAST(NULL AS VARCHAR) AS remark, 'nation' AS mismatched FROM customer""")
def evolve_attributes(t):
    history = t.customer.select(
        F.col("c_custkey").alias("entity_id"), at("2024-01-01 00:00:00").alias("timestamp"),
        attribute_hash(["c_name", "c_nationkey", "c_mktsegment"]).alias("hash"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
    )
    declared = {"name": "text", "nation": "text", "remark": "text"}
    evolved, mismatched = V.evolve_attributes(history, declared, base=["entity_id", "timestamp", "hash"])
    return evolved.withColumn("mismatched", F.lit(",".join(mismatched)))


@query("""SELECT o_orderkey AS entity_id, md5(CAST(o_custkey AS VARCHAR) || o_orderpriority) AS hash, CAST(o_custkey AS VARCHAR) AS customer, o_orderpriority AS priority FROM orders""")
def retype_attribute(t):
    history = t.orders.select(
        F.col("o_orderkey").alias("entity_id"), F.lit("").alias("hash"), F.col("o_custkey").alias("customer"),
        F.col("o_orderpriority").alias("priority"),
    )
    return V.retype_attribute(history, "customer", "text", ["customer", "priority"])


@query("""WITH l AS (SELECT l_linenumber AS line, l_suppkey AS supplier, CAST(l_quantity AS DECIMAL(38,18)) AS quantity FROM lineitem)
    SELECT 'line' AS name, 'integer' AS data_type, 'sum' AS time_aggregation, 'sum' AS entity_aggregation, CAST(max(line) AS VARCHAR) AS max_value FROM l
    UNION ALL SELECT 'supplier', 'bigint', 'sum', 'sum', CAST(max(supplier) AS VARCHAR) FROM l
    UNION ALL SELECT 'quantity', 'numeric', 'sum', 'sum', CAST(max(quantity) AS VARCHAR) FROM l""")
def infer_schema(t):
    """Columns of a view with their types, and the largest value found in each."""
    facts = _facts(t)
    columns = V.infer_schema(facts)
    described = t.spark.createDataFrame(columns, "name string, data_type string, time_aggregation string, entity_aggregation string")
    largest = analyze_part(facts, [name for name, *_ in columns]).select(F.col("trend").alias("name"), "max_value")
    return described.join(largest, "name")
