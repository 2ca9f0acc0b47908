"""Read-only SQL: a statement runs only if all of its parsed plan is known to read named tables and nothing else.

The parser's tree is walked whole, subqueries and named queries included, against lists of what is allowed: kinds of plan
nodes, kinds of expressions, built-in functions by their documented group, and relations that the session's catalog
knows. What isn't listed is refused, so a command, a call into the JVM, a script, a file path or a registered function
does not pass, in whatever words it comes.
"""

from __future__ import annotations

from collections.abc import Collection

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

_PACKAGE = "org.apache.spark.sql.catalyst."
NODES = frozenset(
    "Aggregate Deduplicate Distinct Except Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit LocalRelation Offset OneRowRelation Pivot Project Sample Sort Subquery SubqueryAlias "
    "Tail UnresolvedHaving UnresolvedHint UnresolvedInlineTable UnresolvedRelation UnresolvedSubqueryColumnAliases UnresolvedTVFAliases UnresolvedTableValuedFunction UnresolvedWith Union Unpivot "
    "UsingJoin Window WithWindowDefinition".split()
)
#: Groups of built-in functions that compute on their arguments only, and what is harmless of the miscellaneous ones.
GROUPS = frozenset(
    "agg_funcs array_funcs bitwise_funcs collection_funcs conditional_funcs conversion_funcs csv_funcs datetime_funcs generator_funcs hash_funcs json_funcs lambda_funcs map_funcs math_funcs "
    "predicate_funcs string_funcs struct_funcs url_funcs variant_funcs window_funcs xml_funcs".split()
)
FUNCTIONS = frozenset(("typeof", "uuid", "bitmap_bit_position", "bitmap_bucket_number", "bitmap_count", "equal_null"))
TABLE_FUNCTIONS = frozenset("range explode explode_outer inline inline_outer json_tuple posexplode posexplode_outer stack variant_explode variant_explode_outer".split())
#: Expressions that reach out of the row although no function names them.
EXPRESSIONS_REFUSED = frozenset("CallMethodViaReflection ExpressionWithUnresolvedIdentifier Invoke NewInstance PythonUDF ScalaUDF StaticInvoke TryReflect UnresolvedIdentifier".split())


class ReadOnlyViolation(ValueError):
    pass


class _Walk:
    def __init__(self, spark: SparkSession, tables: Collection[str] | None):
        self.spark, self.tables = spark, tables
        self.gateway, jvm = spark.sparkContext._gateway, spark._jvm
        self.named = jvm.org.apache.spark.sql.catalyst.FunctionIdentifier
        self.builtin = jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.builtin()
        self.own = spark._jsparkSession.sessionState().functionRegistry()
        self.kinds: dict[str, str] = {}
        self.relations: list[list[str]] = []
        self.queries: set[str] = set()

    def _kind(self, x: JavaObject, name: str) -> str:
        if name not in self.kinds:
            test = lambda c: is_instance_of(self.gateway, x, c)
            self.kinds[name] = (
                "type" if name.startswith("org.apache.spark.sql.types.") else "plan" if test(_PACKAGE + "plans.logical.LogicalPlan") else "expression" if test(_PACKAGE + "expressions.Expression")
                else "items" if test("scala.collection.Iterable") else "product" if test("scala.Product") else "value"
            )
        return self.kinds[name]

    def visit(self, x) -> None:
        if not isinstance(x, JavaObject):
            return
        name = x.getClass().getName()
        kind = self._kind(x, name)
        if kind in ("type", "value"):
            return
        simple = name.rpartition(".")[2].rstrip("$")
        if kind == "plan":
            self._plan(x, simple, name)
        elif kind == "expression":
            self._expression(x, simple, name)
        parts = x.iterator() if kind == "items" else x.productIterator()
        while parts.hasNext():
            self.visit(parts.next())

    def _plan(self, x: JavaObject, simple: str, name: str) -> None:
        if simple not in NODES or not name.startswith(_PACKAGE):
            raise ReadOnlyViolation(f"{simple} is not allowed")
        if simple == "UnresolvedRelation":
            self.relations.append(self._names(x.multipartIdentifier()))
        elif simple == "UnresolvedTableValuedFunction":
            self._one_of(self._names(x.name()), TABLE_FUNCTIONS)
        elif simple == "UnresolvedWith":
            queries = x.cteRelations().iterator()
            while queries.hasNext():
                self.queries.add(queries.next()._1().lower())

    def _expression(self, x: JavaObject, simple: str, name: str) -> None:
        if simple in EXPRESSIONS_REFUSED or not name.startswith(_PACKAGE):
            raise ReadOnlyViolation(f"{simple} is not allowed")
        if simple == "UnresolvedFunction":
            self._function(self._names(x.nameParts()))
        elif simple == "UnresolvedGenerator":
            self._function([x.name().funcName()])

    def _names(self, parts: JavaObject) -> list[str]:
        return [parts.apply(i) for i in range(parts.size())]

    def _one_of(self, parts: list[str], allowed: Collection[str]) -> None:
        if len(parts) != 1 or parts[0].lower() not in allowed:
            raise ReadOnlyViolation(f"{'.'.join(parts)} is not allowed")

    def _function(self, parts: list[str]) -> None:
        name = parts[-1].lower()
        own = self.named(name)
        found = self.builtin.lookupFunction(own) if len(parts) == 1 else None
        # a registered function may hide a built-in one
        hidden = found is not None and found.isDefined() and self.own.lookupFunction(own).get().getClassName() != found.get().getClassName()
        if found is None or not found.isDefined() or hidden or (found.get().getGroup() not in GROUPS and name not in FUNCTIONS):
            raise ReadOnlyViolation(f"function {'.'.join(parts)} is not allowed")

    def check_relations(self) -> None:
        for parts in self.relations:
            if len(parts) == 1 and parts[0].lower() in self.queries:
                continue
            name = ".".join(parts)
            if self.tables is not None and name not in self.tables:
                raise ReadOnlyViolation(f"table {name} is not allowed")
            if not self.spark.catalog.tableExists(".".join(f"`{p.replace('`', '``')}`" for p in parts)):
                raise ReadOnlyViolation(f"{name} is not a table")


def check(spark: SparkSession, sql: str, tables: Collection[str] | None = None) -> None:
    """Raises ReadOnlyViolation unless the statement only reads; tables: the relations that it may read, all of the catalog's if None."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except ParseException as e:
        raise ReadOnlyViolation(f"not one statement that can be read: {str(e).strip().splitlines()[0]}") from None
    walk = _Walk(spark, tables)
    walk.visit(plan)
    walk.check_relations()


def query(spark: SparkSession, sql: str, args=None, tables: Collection[str] | None = None) -> DataFrame:
    """The rows of a statement that only reads; a closing semicolon is allowed."""
    bare = sql.strip().rstrip(";")
    check(spark, bare, tables)
    return spark.sql(bare, args=args) if args else spark.sql(bare)
