"""Small literal inputs: two labels with a rank and without, a port graph, changes as text."""

import json

from graphtide.plans.spec import spec_from_dict

DEPOT_DOC = {
    "mysqlSourceInList": [{"sqlName": "db_1", "address": "localhost", "port": 3306}],
    "graphSink": {
        "tagList": [{
            "sinkName": "crate", "graphSpace": "depot", "sourceSql": "db_1",
            "sourceDatabase": "yard", "sourceTable": "crate",
            "idIndex": {"sqlCol": "id", "position": 0, "type": "int"},
            "fieldList": [{"name": "name", "sqlCol": "name", "position": 1},
                          {"name": "age", "sqlCol": "age", "position": 2, "type": "int"}],
        }],
        "edgeList": [{
            "sinkName": "lashing", "graphSpace": "depot", "sourceSql": "db_1",
            "sourceDatabase": "yard", "sourceTable": "lashing",
            "srcIndex": {"sqlCol": "inner", "position": 0, "type": "int"},
            "dstIndex": {"sqlCol": "outer", "position": 1, "type": "int"},
            "rankIndex": {"sqlCol": "layer", "position": 3, "type": "int"},
            "fieldList": [
                {"name": "note", "sqlCol": "note", "position": 2},
                {"name": "level", "sqlCol": "layer", "position": 3, "type": "int"},
                {"name": "weight", "sqlCol": "weight", "position": 4, "type": "decimal(3,1)"},
                {"name": "since", "sqlCol": "since", "position": 5},
                {"name": "place", "sqlCol": "place", "position": 6},
            ],
        }],
    },
}

PORT_DOC = {
    "graphSink": {
        "tagList": [
            {"sinkName": "berth", "graphSpace": "port", "sourceSql": "db_1", "sourceDatabase": "yard",
             "sourceTable": "berth", "idIndex": {"sqlCol": "berthno", "position": 0},
             "fieldList": [{"name": "name", "sqlCol": "name", "position": 1},
                           {"name": "age", "sqlCol": "age", "position": 2, "type": "int"}]},
            {"sinkName": "harbour", "graphSpace": "port", "sourceSql": "db_1", "sourceDatabase": "yard",
             "sourceTable": "harbour", "idIndex": {"sqlCol": "harbourno", "position": 0},
             "fieldList": [{"name": "name", "sqlCol": "name", "position": 1}]},
        ],
        "edgeList": [
            {"sinkName": "channel", "graphSpace": "port", "sourceSql": "db_1", "sourceDatabase": "yard",
             "sourceTable": "channel", "srcIndex": {"sqlCol": "from_berth", "position": 0},
             "dstIndex": {"sqlCol": "to_berth", "position": 1},
             "fieldList": [{"name": "depth", "sqlCol": "depth", "position": 2, "type": "int"}]},
            {"sinkName": "lease", "graphSpace": "port", "sourceSql": "db_1", "sourceDatabase": "yard",
             "sourceTable": "lease", "srcIndex": {"sqlCol": "berthno", "position": 0},
             "dstIndex": {"sqlCol": "harbourno", "position": 1},
             "fieldList": [{"name": "opened", "sqlCol": "opened", "position": 2, "type": "int"},
                           {"name": "closed", "sqlCol": "closed", "position": 3, "type": "int"}]},
        ],
    },
}

DEPOT = spec_from_dict(DEPOT_DOC)
PORT = spec_from_dict(PORT_DOC)
KEYS = {"crate": ["id"], "lashing": ["inner", "outer", "layer"], "berth": ["berthno"], "harbour": ["harbourno"],
        "channel": ["from_berth", "to_berth"], "lease": ["berthno", "harbourno"]}


def change(op, table, data, at=0, table_name=None, **more):
    """One envelope as text; ``at`` is its place in the order of changes."""
    doc = {"op": op, "ts_sec": 1_600_000_000, "db": "yard", "table": table_name or table, "key": KEYS[table], "data": data,
           "parse_time": 1_600_000_001, "seq": {"ts_sec": 1_600_000_000, "file": "bin.1", "pos": at, "row": 0}}
    return json.dumps({**doc, **more})


def feed(spark, *texts, source="db_1"):
    return spark.createDataFrame([(t, source) for t in texts], "value string, source string")
