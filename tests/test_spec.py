import copy
import json

import pytest

from graphtide.plans.spec import EdgeMap, KeyRef, Prop, SpecError, VertexMap, load_spec, spec_from_dict, with_types
from tests.samples import DEPOT, DEPOT_DOC, PORT, PORT_DOC


def changed(edit):
    doc = copy.deepcopy(DEPOT_DOC)
    edit(doc["graphSink"])
    return doc


def test_slot_order():
    assert DEPOT.label("crate").slots == ["id", "name", "age"]
    # The rank is also a property, so it is not inserted again.
    assert DEPOT.label("lashing").slots == ["inner", "outer", "note", "layer", "weight", "since", "place"]
    assert PORT.label("port.lease").slots == ["berthno", "harbourno", "opened", "closed"]


def test_index_columns_and_keys():
    assert DEPOT.label("lashing").index_columns == ["inner", "outer", "layer"]
    assert PORT.label("channel").index_columns == ["from_berth", "to_berth"]
    assert PORT.label("channel").key_names == ["_src", "_dst", "_rank"]


def test_captured_tables_are_distinct():
    assert PORT.captured_tables() == {"db_1": ["yard.berth", "yard.channel", "yard.harbour", "yard.lease"]}


def test_missing_lists_are_empty():
    spec = spec_from_dict({"graphSink": {"tagList": None, "edgeList": PORT_DOC["graphSink"]["edgeList"]}})
    assert len(spec.vertices) == 0 and len(spec.edges) == 2


@pytest.mark.parametrize("edit, complaint", [
    (lambda s: s["tagList"][0].update(sourceSql="other"), "not among"),
    (lambda s: s["tagList"][0].pop("idIndex"), "idIndex"),
    (lambda s: s["edgeList"][0]["srcIndex"].update(sqlCol=""), "srcIndex"),
    (lambda s: s["tagList"][0]["fieldList"][0].update(position=2), "position"),
    (lambda s: s["tagList"][0]["idIndex"].update(position=7), "position 7"),
    (lambda s: s["tagList"][0].pop("sourceTable"), "sourceTable"),
    (lambda s: s["tagList"].append(s["tagList"][0]), "mapped twice"),
    (lambda s: s["tagList"][0]["fieldList"][1].update(name="NAME"), "repeated"),
    (lambda s: s["tagList"][0]["fieldList"][1].update(name="_vid"), "reserved"),
])
def test_unusable_mappings_are_refused(edit, complaint):
    with pytest.raises(SpecError, match=complaint):
        spec_from_dict(changed(edit))


def test_rank_block_without_column_is_no_rank():
    spec = spec_from_dict(changed(lambda s: s["edgeList"][0].update(rankIndex={"sqlCol": "", "position": 3})))
    assert spec.label("lashing").rank is None


def test_conflicting_types_are_refused():
    label = EdgeMap("e", "s", "d", "t", (Prop("r", "rk", "string"),), src=KeyRef("a"), dst=KeyRef("b"),
                    rank=KeyRef("rk", "int"))
    with pytest.raises(SpecError, match="declared both"):
        label.validate()


def test_positions_are_optional():
    label = VertexMap("v", "s", "d", "t", (Prop("n", "n"), Prop("a", "a")), id=KeyRef("id"))
    label.validate()
    assert label.slots == ["id", "n", "a"]


def test_load_json_and_yaml(tmp_path):
    path = tmp_path / "map.json"
    path.write_text(json.dumps(DEPOT_DOC))
    assert load_spec(str(path)) == DEPOT
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "map.yaml"
    path.write_text(yaml.safe_dump(DEPOT_DOC))
    assert load_spec(str(path)) == DEPOT


def test_types_can_be_declared_apart():
    typed = with_types(PORT, {"yard.berth": {"berthno": "bigint"}})
    assert typed.label("berth").column_types["berthno"] == "bigint"
    assert typed.label("harbour").type_of("harbourno") == "string"


def test_bare_label_keeps_keys_and_types():
    bare = DEPOT.label("lashing").bare()
    assert bare.slots == ["inner", "outer", "layer"] and bare.prop_names == []
    assert bare.type_of("layer") == "int" and bare.label == "depot.lashing"
    assert PORT.label("channel").bare().rank is None


def test_several_tables_may_feed_one_label():
    def second(sink):
        sink["tagList"].append({**sink["tagList"][0], "sourceTable": "crate_archive"})

    spec = spec_from_dict(changed(second))
    assert len(spec.mappings(spec.label("crate"))) == 2 and len(spec.distinct("vertex")) == 1

    def unlike(sink):
        second(sink)
        sink["tagList"][1] = {**sink["tagList"][1], "fieldList": sink["tagList"][1]["fieldList"][:1]}

    with pytest.raises(SpecError, match="differ in keys"):
        spec_from_dict(changed(unlike))
