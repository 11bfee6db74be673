"""Row-level security: what users see and write, and which policy changes are refused."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import security as sec
from tidemark.operators.compare import assert_same_rows

TWO, THREE, ALL, DBO = (sec.User.of(n) for n in ("SalesPerson2", "SalesPerson3", "SalesPersonAll", "dbo"))
STRANGER = sec.User.of("SalesPerson67")


def simple_access():
    # Names are written in another case than the users': they are the same users.
    return sec.by_case({"Salesperson2": 2, "Salesperson3": 3, "Salesperson6": 6}) | sec.allow_all(["Salespersonall", "dbo"])


@pytest.fixture()
def orders(spark):
    rows = [(n, person, 5) for n, person in enumerate([2, 2, 3, 6, 7, None, 3])]
    return spark.createDataFrame(rows, "OrderID INT, SalespersonPersonID INT, ContactPersonID INT")


@pytest.fixture()
def registry():
    r = sec.SecurityRegistry()
    r.define("SimpleOrderAccess", simple_access())
    r.create_policy("SimpleSalesPersonAccess")
    r.add_filter("SimpleSalesPersonAccess", "SimpleOrderAccess", "Orders", "SalespersonPersonID")
    return r


def people(df):
    return sorted((r["SalespersonPersonID"] for r in df.collect()), key=lambda p: (p is None, p))


def test_each_user_sees_their_rows(registry, orders):
    assert people(registry.read("Orders", orders, TWO)) == [2, 2]
    assert people(registry.read("Orders", orders, THREE)) == [3, 3]
    assert people(registry.read("Orders", orders, ALL)) == people(orders)
    assert people(registry.read("Orders", orders, DBO)) == people(orders)
    assert people(registry.read("Orders", orders, STRANGER)) == []
    assert people(registry.read("Invoices", orders, STRANGER)) == people(orders)


def test_administrator_must_be_named(orders):
    assert people(sec.permitted(orders, sec.by_case({"Salesperson2": 2}), "SalespersonPersonID", DBO)) == []


def test_several_values(orders):
    access = simple_access() | sec.by_values({"Salesperson3": [3, 6]})
    assert people(sec.permitted(orders, access, "SalespersonPersonID", THREE)) == [3, 3, 6]


@pytest.mark.parametrize("max_literals", [100, 1, 0])
def test_lookup_table(spark, orders, max_literals):
    access_rows = [(1, 1, "SalesPerson1", 1), (2, 2, "SalesPerson2", 2), (3, 3, "SalesPerson3", 3), (4, 3, "SalesPerson3", 6)]
    access_rows.append((5, 3, "SalesPerson3", None))
    table = spark.createDataFrame(access_rows, "UserOrgAccessID INT, UserID INT, UserName STRING, OrgID INT")
    access = sec.by_lookup(table, "UserName", "OrgID", max_literals) | sec.allow_all(["dbo"])
    for user, seen in ((TWO, [2, 2]), (THREE, [3, 3, 6]), (STRANGER, []), (DBO, people(orders))):
        assert people(sec.permitted(orders, access, "SalespersonPersonID", user)) == seen


@pytest.mark.parametrize("max_literals", [100, 0])
def test_own_rows_or_role(spark, orders, max_literals):
    users = spark.createDataFrame([(2, "User2"), (3, "User3")], "UserID INT, Username STRING")
    access = sec.by_join(users, "Username", "UserID", "sysadmin", max_literals)
    assert people(sec.permitted(orders, access, "SalespersonPersonID", sec.User.of("user3"))) == [3, 3]
    assert people(sec.permitted(orders, access, "SalespersonPersonID", sec.User.of("sa", ["SysAdmin"]))) == people(orders)


def test_a_view_does_not_let_conditions_pass(spark, orders):
    """The policy is on one side of a join; the caller's condition fails on a hidden row of the other."""
    notes = spark.createDataFrame([(2, 7), (3, 0), (4, 5)], "p INT, divisor INT")
    view = orders.join(notes, F.col("p") == F.col("SalespersonPersonID"))
    seen = sec.permitted(view, sec.by_case({"SalesPerson2": 2}), "SalespersonPersonID", TWO)
    assert seen.where(1 / F.col("divisor") > 0).count() == seen.count() > 0
    plan = spark._jvm.PythonSQLUtils.explainString(seen.where(1 / F.col("divisor") > 0)._jdf.queryExecution(), "simple")
    assert "Sample" in plan


@pytest.mark.parametrize("max_literals", [100, 0])
def test_errors_do_not_reveal_hidden_rows(spark, orders, max_literals):
    """A caller's division fails on a row of person 3, which person 2 may not see."""
    table = spark.createDataFrame([("SalesPerson2", 2)], "UserName STRING, OrgID INT")
    access = sec.by_lookup(table, "UserName", "OrgID", max_literals)
    seen = sec.permitted(orders, access, "SalespersonPersonID", TWO)
    inverse = 1 / (F.col("SalespersonPersonID") - 3)
    assert seen.where(inverse < 0).count() == 2
    assert [r[0] for r in seen.select(inverse).collect()] == [-1.0, -1.0]
    # No 3 in the caller's own table: the optimizer may try the condition on its key as well.
    other = spark.createDataFrame([(2, "x"), (4, "y")], "p INT, n STRING")
    assert seen.join(other, F.col("p") == F.col("SalespersonPersonID")).where(inverse < 0).count() == 2
    registry = sec.SecurityRegistry()
    registry.define("f", access)
    registry.create_policy("p")
    registry.add_filter("p", "f", "Orders", "SalespersonPersonID")
    changed = registry.update("Orders", orders, inverse < 0, {"ContactPersonID": F.lit(1)}, TWO)
    assert changed.where(F.col("ContactPersonID") == 1).count() == 2


def test_joins(spark, registry, orders):
    invoices = orders.select(F.col("OrderID").alias("InvoiceOrder"), F.col("SalespersonPersonID").alias("InvoicePerson"))
    on = F.col("InvoiceOrder") == F.col("OrderID")
    threes = invoices.where(F.col("InvoicePerson") == 3)
    seen = registry.read("Orders", orders, TWO)
    assert threes.join(seen, on).count() == 0
    assert [r["OrderID"] for r in threes.join(seen, on, "left").collect()] == [None, None]
    registry.add_filter("SimpleSalesPersonAccess", "SimpleOrderAccess", "Invoices", "InvoicePerson")
    hidden = registry.read("Invoices", threes, TWO)
    assert hidden.join(seen, on, "left").count() == 0


def new_order(spark, number, person):
    return spark.createDataFrame([(number, person, 5)], "OrderID INT, SalespersonPersonID INT, ContactPersonID INT")


def test_filter_alone_does_not_stop_writes(spark, registry, orders):
    after = registry.insert("Orders", orders, new_order(spark, 73597, 3), TWO)
    assert registry.read("Orders", after, TWO).where("OrderID = 73597").count() == 0
    assert registry.read("Orders", after, THREE).where("OrderID = 73597").count() == 1
    is_new = F.col("OrderID") == 73597
    assert_same_rows(after, registry.update("Orders", after, is_new, {"ContactPersonID": F.lit(6)}, TWO))
    assert_same_rows(after, registry.delete("Orders", after, is_new, TWO))
    own = registry.insert("Orders", after, new_order(spark, 73600, 2), TWO)
    moved = registry.update("Orders", own, F.col("OrderID") == 73600, {"SalespersonPersonID": F.lit(3)}, TWO)
    assert registry.read("Orders", moved, TWO).where("OrderID = 73600").count() == 0
    assert registry.read("Orders", moved, THREE).where("OrderID = 73600").count() == 1
    gone = registry.delete("Orders", own, F.col("OrderID") == 73600, TWO)
    assert_same_rows(after, gone)


def test_blocked_insert(spark, registry, orders):
    registry.add_block("SimpleSalesPersonAccess", "SimpleOrderAccess", "Orders", "SalespersonPersonID", sec.AFTER_INSERT)
    for person in (3, None):
        with pytest.raises(sec.BlockedError):
            registry.insert("Orders", orders, new_order(spark, 73602, person), TWO)
    assert registry.insert("Orders", orders, new_order(spark, 73602, 2), TWO).count() == orders.count() + 1


def block_only(*operations):
    r = sec.SecurityRegistry()
    r.define("Writes", simple_access())
    r.create_policy("Blocks")
    for operation in operations:
        r.add_block("Blocks", "Writes", "Orders", "SalespersonPersonID", operation)
    return r


def test_blocked_update_and_delete(orders):
    threes = F.col("SalespersonPersonID") == 3
    to_two, to_three = ({"SalespersonPersonID": F.lit(p)} for p in (2, 3))
    after = block_only(sec.AFTER_UPDATE)
    assert after.update("Orders", orders, threes, to_two, TWO).where("SalespersonPersonID = 2").count() == 4
    with pytest.raises(sec.BlockedError):
        after.update("Orders", orders, F.col("OrderID") == 0, to_three, TWO)
    before = block_only(sec.BEFORE_UPDATE)
    assert before.update("Orders", orders, F.col("OrderID") == 0, to_three, TWO).where("SalespersonPersonID = 3").count() == 3
    with pytest.raises(sec.BlockedError):
        before.update("Orders", orders, threes, to_two, TWO)
    deletes = block_only(sec.BEFORE_DELETE)
    assert deletes.delete("Orders", orders, F.col("OrderID") == 0, TWO).count() == orders.count() - 1
    with pytest.raises(sec.BlockedError):
        deletes.delete("Orders", orders, threes, TWO)


def test_hidden_rows_are_passed_over_even_with_blocks(registry, orders):
    for operation in sec.OPERATIONS:
        registry.add_block("SimpleSalesPersonAccess", "SimpleOrderAccess", "Orders", "SalespersonPersonID", operation)
    threes = F.col("SalespersonPersonID") == 3
    assert_same_rows(orders, registry.update("Orders", orders, threes, {"SalespersonPersonID": F.lit(2)}, TWO))
    assert_same_rows(orders, registry.delete("Orders", orders, threes, TWO))


def test_one_predicate_per_kind_and_one_policy_per_table(registry):
    registry.define("SecondSecFunction", simple_access())
    registry.add_block("SimpleSalesPersonAccess", "SecondSecFunction", "Orders", "SalespersonPersonID", sec.AFTER_INSERT)
    registry.add_block("SimpleSalesPersonAccess", "SecondSecFunction", "Orders", "SalespersonPersonID", sec.AFTER_UPDATE)
    with pytest.raises(sec.PolicyError):
        registry.add_filter("SimpleSalesPersonAccess", "SecondSecFunction", "Orders", "ContactPersonID")
    registry.create_policy("SecondPolicy")
    with pytest.raises(sec.PolicyError):
        registry.add_block("SecondPolicy", "SecondSecFunction", "Orders", "SalespersonPersonID", sec.BEFORE_DELETE)
    with pytest.raises(sec.PolicyError):
        registry.add_filter("SecondPolicy", "SecondSecFunction", "Orders", "ContactPersonID")
    registry.set_enabled("SecondPolicy", False)
    registry.add_filter("SecondPolicy", "SecondSecFunction", "Orders", "ContactPersonID")
    with pytest.raises(sec.PolicyError):
        registry.set_enabled("SecondPolicy", True)
    with pytest.raises(sec.PolicyError):
        registry.add_block("SimpleSalesPersonAccess", "SecondSecFunction", "Orders", "SalespersonPersonID", "AFTER DELETE")


def test_states_and_bound_predicates(registry, orders):
    narrower = sec.by_case({"Salesperson2": 2})
    with pytest.raises(sec.PolicyError):
        registry.alter("SimpleOrderAccess", narrower)
    registry.set_enabled("SimpleSalesPersonAccess", False)
    assert people(registry.read("Orders", orders, TWO)) == people(orders)
    with pytest.raises(sec.PolicyError):
        registry.alter("SimpleOrderAccess", narrower)
    registry.set_enabled("SimpleSalesPersonAccess", True)
    registry.drop_filter("SimpleSalesPersonAccess", "Orders")
    registry.alter("SimpleOrderAccess", narrower)
    registry.add_filter("SimpleSalesPersonAccess", "SimpleOrderAccess", "Orders", "SalespersonPersonID")
    assert people(registry.read("Orders", orders, DBO)) == []
    registry.drop_policy("SimpleSalesPersonAccess")
    assert people(registry.read("Orders", orders, STRANGER)) == people(orders)


def test_inventory_and_counts(spark, registry, orders):
    registry.add_block("SimpleSalesPersonAccess", "SimpleOrderAccess", "Orders", "SalespersonPersonID", sec.AFTER_INSERT)
    rows = registry.inventory(spark).collect()
    assert [(r["predicate_type"], r["operation"], r["table"], r["is_enabled"]) for r in rows] == [
        ("FILTER", None, "Orders", True),
        ("BLOCK", "AFTER INSERT", "Orders", True),
    ]
    counts = registry.visible_counts("Orders", orders, [TWO, ALL, STRANGER]).collect()
    assert {r["user_name"]: r["visible_rows"] for r in counts} == {"salesperson2": 2, "salespersonall": 7, "salesperson67": 0}
    per = sec.rows_per(orders, "SalespersonPersonID").collect()
    assert [(r[0], r[1]) for r in per] == [(None, 1), (2, 2), (3, 2), (6, 1), (7, 1)]
