"""Ad-hoc SQL over the curated views, judged by Spark's own parser.

The parsed plan is walked node by node, with the names that are in scope at
each: a WITH clause's names hold in its own query and in the definitions after
them, not in their own, and end where the query ends.  Any other name is a
relation that the text reads.  Texts inside literals are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.sources.footers import column_bytes, footers

# Fixed values of the guard.
RESULT_ROW_LIMIT = 200
MAX_SCAN_BYTES = 2 * 1024**3

# The parsed plan nodes that a query may have; any other refuses it.  A lateral
# view is allowed for the generators below, which read no relation; lateral
# subqueries, table functions and hints are refused.
QUERY_NODES = frozenset(
    "Project Filter Aggregate Sort GlobalLimit LocalLimit Offset Distinct Union Except Intersect Join "
    "SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedRelation UnresolvedHaving UnresolvedInlineTable "
    "UnresolvedWith WithWindowDefinition OneRowRelation LocalRelation Generate".split()
)
GENERATORS = frozenset("explode explode_outer posexplode posexplode_outer inline inline_outer stack".split())
REFLECTION = frozenset("reflect try_reflect java_method".split())
# The expressions that hold a query.
SUBQUERIES = frozenset("ScalarSubquery Exists ListQuery LateralSubquery".split())


def _items(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _dotted(parts) -> str:
    return ".".join(_items(parts))


def _expressions(node, sql: str) -> Iterator:
    """Every expression of one plan node, refusing calls into the JVM and
    functions that are named by an expression."""
    todo = list(_items(node.expressions()))
    if _kind(node) == "WithWindowDefinition":
        todo += _items(node.windowDefinitions().values().toSeq())
    while todo:
        one = todo.pop()
        if _kind(one) == "ExpressionWithUnresolvedIdentifier":
            raise ValueError(f"no names made by expressions: {sql}")
        name = {"UnresolvedFunction": "nameParts", "UnresolvedGenerator": "name"}.get(_kind(one))
        if name == "nameParts" and _dotted(one.nameParts()).lower().split(".")[-1] in REFLECTION:
            raise ValueError(f"no calls into the JVM: {sql}")
        if name == "name" and one.name().funcName().lower() not in GENERATORS:
            raise ValueError(f"not a generator of this guard ({one.name().funcName()}): {sql}")
        yield one
        todo.extend(_items(one.children()))


def _relations(plan, scope: frozenset[str], sql: str) -> Iterator[str]:
    """Relations that a parsed plan reads, where ``scope`` has the names of WITH clauses around it."""
    kind = _kind(plan)
    if kind not in QUERY_NODES:
        raise ValueError(f"not a plain query ({kind}): {sql}")
    if kind == "UnresolvedRelation":
        name = _dotted(plan.multipartIdentifier()).lower()
        if plan.multipartIdentifier().size() > 1 or name not in scope:
            yield name
        return
    if kind == "UnresolvedWith":
        for definition in _items(plan.cteRelations()):
            name = definition._1().lower()
            inner = scope | {name} if plan.allowRecursion() else scope
            yield from _relations(definition._2(), inner, sql)
            scope = scope | {name}
        yield from _relations(plan.child(), scope, sql)
        return
    for one in _expressions(plan, sql):
        if _kind(one) in SUBQUERIES:
            yield from _relations(one.plan(), scope, sql)
    for child in _items(plan.children()):
        yield from _relations(child, scope, sql)


def relations_of(spark: SparkSession, sql: str) -> set[str]:
    """The relations that one query reads, by name; ValueError when it is
    anything but a query or calls into the JVM.  Nothing is run."""
    parser = spark._jsparkSession.sessionState().sqlParser()
    try:
        plan = parser.parsePlan(sql.strip().rstrip(";"))
    except Exception as bad:
        raise ValueError(f"not one SQL query: {sql}") from bad
    return set(_relations(plan, frozenset(), sql))


def _leaves(node) -> Iterator:
    """Leaf nodes of a physical plan, those of its subqueries too, reused ones once."""
    for sub in _items(node.subqueries()):
        if not _kind(sub).startswith("Reused"):
            yield from _leaves(sub)
    children = list(_items(node.children()))
    if not children and not _kind(node).startswith("Reused"):
        yield node
    for child in children:
        yield from _leaves(child)


def _scanned_files(scan) -> list[str]:
    """The files of the partitions that a file scan's filters leave."""
    location = scan.relation().location()
    found = location.listFiles(scan.partitionFilters(), scan.dataFilters())
    return [f.getPath().toString() for folder in _items(found) for f in _items(folder.files())]


def _logical_bytes(node) -> int:
    link = node.logicalLink()
    return int(str(link.get().stats().sizeInBytes())) if link.isDefined() else 0


def estimated_scan_bytes(df: DataFrame) -> int:
    """Stored bytes of the columns that the plan's file scans need, in the
    partitions that their filters leave, from the files' footers (a job that
    reads no data).  Other leaves count with the optimizer's estimate."""
    spark = df.sparkSession
    logical = df._jdf.queryExecution().logical()
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else subqueries are planned as the query runs
    try:
        plan = spark._jsparkSession.sessionState().executePlan(logical, _eager(spark)).executedPlan()
        total, wanted = 0, []
        for leaf in _leaves(plan):
            if _kind(leaf) == "FileSourceScanExec" and leaf.relation().fileFormat().toString() == "Parquet":
                wanted.append((_scanned_files(leaf), list(leaf.requiredSchema().fieldNames())))
            else:
                total += _logical_bytes(leaf)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    for paths, names in wanted:
        if paths and names:
            sizes = column_bytes(footers(spark, paths), names)
            total += sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    return total


def _eager(spark: SparkSession):
    return spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP()


def guarded_query(spark: SparkSession, sql: str, names: Iterable[str], max_rows: int = RESULT_ROW_LIMIT,
                  max_bytes: int | None = MAX_SCAN_BYTES) -> DataFrame:
    """The query's rows, at most ``max_rows``, when it reads the named views
    only and not more than ``max_bytes`` (None: any number)."""
    others = relations_of(spark, sql) - {n.lower() for n in names}
    if others:
        raise ValueError(f"relations outside the views: {', '.join(sorted(others))}")
    df = spark.sql(sql.strip().rstrip(";"))
    if max_bytes is not None and (size := estimated_scan_bytes(df)) > max_bytes:
        raise ValueError(f"query would scan ~{size:,} bytes (cap {max_bytes:,})")
    return df.limit(max_rows)
