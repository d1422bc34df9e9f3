"""Gates: what a transform refuses, on catalogues that differ from the fixture in one relation."""

import json
import os

import pytest

from catrec.operators.gates import GateError
from catrec.options import CatalogueOptions
from catrec.plans.transform import transform_snapshot
from catrec.sources.records import read_records
from tests.fixtures import ATTIC, DEPOT, DEPOT_RECORDS, create_snapshot

ALL = CatalogueOptions(env="UAT")
DEPOT_ONLY = CatalogueOptions(env="UAT", database_pattern="^depot$")


def run(spark, scratch, options, name="out", **relations):
    root = create_snapshot(os.path.join(scratch, f"of-{name}"), **relations)
    return transform_snapshot(spark, root, os.path.join(scratch, name), options)


@pytest.mark.parametrize(("relation", "rows", "message"), [
    ("TBLS", ("TBL_ID DB_ID TBL_NAME", [(3, DEPOT, "x"), (3, ATTIC, "y")]), "duplicate"),
    ("DBS", ("DB_ID NAME", [(DEPOT, "depot"), (DEPOT, "depot two")]), "duplicate"),
    ("TBLS", ("TBL_ID DB_ID TBL_NAME", [(3, DEPOT, "x"), (4, DEPOT, "left(right")]), "delimiter"),
])
def test_gates_stop_the_transform(spark, scratch, relation, rows, message):
    with pytest.raises(GateError, match=message):
        run(spark, scratch, ALL, **{relation: rows})
    assert not os.path.exists(os.path.join(scratch, "out"))


def test_an_id_repeated_among_databases_that_are_filtered_out_is_no_matter(spark, scratch):
    rows = ("DB_ID NAME", [(DEPOT, "depot"), (DEPOT, "store"), (ATTIC, "attic")])
    assert run(spark, scratch, DEPOT_ONLY, DBS=rows).databases == 1


def test_every_exported_database_has_its_container(spark, scratch):
    whole = run(spark, scratch, ALL)
    assert (whole.databases, whole.tables, whole.mcps) == (2, 5, DEPOT_RECORDS + 6 + 6)
    bare = run(spark, scratch, ALL, "bare", TBLS=("TBL_ID DB_ID TBL_NAME", []))
    assert (bare.databases, bare.tables, bare.mcps) == (2, 0, 5 + 2 * 6)


@pytest.mark.parametrize("text", ['{"a": ', "[1, 2]", "nothing", '{"entityUrn": "u"} trailing'])
def test_text_that_is_no_record_fails_the_read(spark, scratch, text):
    with open(os.path.join(scratch, "part-7"), "w") as out:
        out.write(json.dumps({"entityUrn": "u", "aspectName": "status", "aspect": {}}) + "\n" + text + "\n")
    with pytest.raises(Exception, match="not a JSON object|neither an MCP"):
        read_records(spark, scratch).collect()
