import json

import pytest

from proofline import contract as C
from proofline.functions import naming
from proofline.plans.payments import PAYMENTS


def raw(**over):
    base = {
        "tables": [
            {"name": "a", "primary_key": "id", "columns": [{"name": "id", "type": "int"}, {"name": "m", "type": "money", "nullable": True}]},
            {
                "name": "b",
                "primary_key": "id",
                "parent": {"column": "a_id", "table": "a"},
                "columns": [
                    {"name": "id", "type": "bigint"},
                    {"name": "a_id", "type": "int"},
                    {"name": "g", "type": "generated", "expr": "id + 1"},
                    {"name": "at", "type": "timestamp"},
                ],
            },
        ]
    }
    base.update(over)
    return base


def test_selectors():
    c = C.from_dict(raw())
    assert c.names == ["a", "b"]
    assert c.table("a").money == ["m"] and c.table("a").nullable == ["m"]
    assert c.table("b").money == ["g"] and c.table("b").dated == ["at"]
    assert [f.name for f in c.table("b").stored] == ["id", "a_id", "at"]
    assert [(x.name, l.column, y.name) for x, l, y in c.edges()] == [("b", "a_id", "a")]


def test_several_parents_are_kept():
    t = raw()
    t["tables"][1]["parents"] = [{"column": "id", "table": "a"}]
    assert len(C.from_dict(t).edges()) == 2


@pytest.mark.parametrize(
    "break_it",
    [
        lambda t: t["tables"][0]["columns"][1].update(type="mony"),
        lambda t: t["tables"][0].pop("primary_key"),
        lambda t: t["tables"][0].update(primary_key="nope"),
        lambda t: t["tables"][1]["parent"].update(table="zzz"),
        lambda t: t["tables"][1]["parent"].update(column="zzz"),
        lambda t: t["tables"].reverse(),
        lambda t: t["tables"].append(t["tables"][0]),
        lambda t: t.update(source_timezone="Mars/Olympus"),
        lambda t: t.update(collation_check={"table": "a", "column": "zz", "value": "x"}),
    ],
)
def test_broken_contracts_fail_early(break_it):
    t = raw()
    break_it(t)
    with pytest.raises(C.ContractError):
        C.from_dict(t)


def test_load_from_environment(tmp_path, monkeypatch):
    file = tmp_path / "contract.json"
    file.write_text(json.dumps(raw(_comment="ignored")), encoding="utf-8")
    monkeypatch.setenv("SCHEMA_CONFIG", str(file))
    assert C.load().names == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        C.load(str(tmp_path / "missing.json"))


def test_table_patterns():
    assert PAYMENTS.select_tables("%") == PAYMENTS.names
    assert PAYMENTS.select_tables("%tion%") == ["transactions"]
    assert PAYMENTS.select_tables("b%") == ["batches"]
    assert PAYMENTS.select_tables("nothing") == []


def test_struct_types():
    s = PAYMENTS.table("transactions").struct()
    assert s["amount"].dataType.simpleString() == "decimal(19,4)"
    assert s["txn_id"].dataType.simpleString() == "bigint"
    assert s["captured_at"].dataType.simpleString() == "timestamp"


def test_mapping_rules(spark):
    mapping = {
        "rules": [
            {"rule-type": "transformation", "rule-id": "2", "rule-target": "schema", "object-locator": {"schema-name": "src"}, "rule-action": "rename", "value": "dst"},
            {"rule-type": "selection", "rule-id": "1", "object-locator": {"table-name": "t%"}, "rule-action": "include"},
            {"rule-type": "transformation", "rule-id": "3", "rule-target": "column", "object-locator": {"column-name": "%"}, "rule-action": "convert-lowercase"},
        ]
    }
    rules, included = naming.parse_rules(mapping)
    assert included == ["t%"]
    assert naming.rename("schema", "src", rules) == "dst"
    assert naming.rename("schema", "other", rules) == "other"
    assert naming.rename("table", "KEEP", rules) == "KEEP"
    assert naming.rename_columns(spark.range(1).toDF("ID"), rules).columns == ["id"]


def rule(number, target, action, value=None, **where):
    located = {f"{k}-name": v for k, v in where.items()}
    kind = {"rule-type": "transformation", "rule-target": target} if target else {"rule-type": "selection"}
    return {**kind, "rule-id": str(number), "rule-action": action, "object-locator": located, "value": value}


def mapping(*rules):
    return naming.Mapping.from_dict({"rules": list(rules)})


def test_selection_needs_an_inclusion_and_no_exclusion():
    m = mapping(rule(1, None, "include", schema="dbo", table="t%"), rule(2, None, "exclude", schema="dbo", table="t_old%"), rule(3, None, "exclude", schema="x"))
    assert [m.selects("dbo", t) for t in ("t1", "t_old", "t_older", "u", "T1")] == [True, False, False, False, False]
    assert not m.selects("x", "t1") and not mapping().selects("dbo", "t")
    assert not mapping(rule(1, None, "include", table="a[b")).selects("dbo", "ab")


def test_the_most_specific_rule_names():
    m = mapping(
        rule(1, "column", "convert-lowercase"), rule(2, "column", "rename", "id", schema="dbo", table="A", column="ROW_ID"),
        rule(3, "column", "rename", "key", column="ROW%"), rule(4, "column", "rename", "other", schema="x", table="A", column="ROW_ID"),
    )
    assert m.name("column", "dbo", "A", "ROW_ID") == "id"
    assert m.name("column", "dbo", "B", "ROW_ID") == "key"
    assert m.name("column", "dbo", "A", "NAME") == "name"
    assert m.name("table", "dbo", "A") == "A"


def test_mappings_that_are_refused(spark):
    two = mapping(rule(1, None, "include"), rule(2, "column", "rename", "a", column="X"), rule(3, "column", "rename", "b", column="X"))
    with pytest.raises(C.ContractError):
        two.name("column", "dbo", "T", "X")
    same = mapping(rule(1, None, "include"), rule(2, "column", "rename", "a", column="X"))
    with pytest.raises(C.ContractError):
        same.apply("dbo", {"T": spark.range(1).selectExpr("id AS X", "id AS A")})
    merged = mapping(rule(1, None, "include"), rule(2, "table", "convert-lowercase"))
    with pytest.raises(C.ContractError):
        merged.apply("dbo", {"T": spark.range(1), "t": spark.range(1)})
    for bad in ([rule(1, None, "include"), rule(1, None, "include")], [rule(1, None, "explicit")], [rule(1, "index", "rename")], [{**rule(1, None, "include"), "filters": [{}]}]):
        with pytest.raises(C.ContractError):
            mapping(*bad)
