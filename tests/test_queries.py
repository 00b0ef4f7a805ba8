"""Registry: coverage of the operator inventory and a sample of queries against their oracle."""
import re

import duckdb
import pytest

import __spark_entry__ as entry
from sitewright.plans import catalog
from sitewright.plans.views import BASE

IDS = """io1 io2 io3 io4 io5 io6 io7 io8 io9 io10 io11 io12 io13 io14 sc1 sc2 sc3 sc4 sc5 sc6 sc7 sc8 sc9 sc10 sc11 sc12 sc13 sc14 sc15 sc16 sc17 sc18 sc19 sc20
sc21 sc22 sc23 sc24 sc25 sc26 sc28 sc29 sc30 fl1 fl2 fl3 fl4 fl5 fl6 fl7 fl8 fl9 fl10 fl11 rj1 rj2 rj3 rj4 rj5 rj6 rj7 rj8 rj9 rj10 rj11 rj12 rj13 rj14 rj15 rj16 rj17
rj18 rj19 rj20 rj21 rj22 rj23 rj24 ag1 ag2 ag3 ag4 ag5 ag6 ag7 ag8 ag9 ag10 ag11 ag12 ag13 ag14 ag15 ag16 ag17 ag18 ag19 ag20 ag21 ag22 ag23 ag24 ag25 ag26 ag27 ag28
ag29 ag30 ag31 ag32 ag33 ag34 ag35 ag36 ag37 ag38 ag39 ag40 wn1 wn2 wn3 wn4 wn5 wn8 wn9 wn10 wn11 wn12 wn13 wn14 wn15 wn16 wn17 wn18 wn19 wn20 dt1 dt2 dt3 dt4 dt5 dt6
dt7 dt8 dt9 dt10 dt11 dt12 dt13 dt14 dt15 dt16 dt17 dt19 it1 it2 it3 cu1 cu2 cu3 cu4 cu5 cu6 cu7 cu8 cu9 cu10 cu12""".split()

SAMPLE = ["ag1_anchored_chain", "rj10_pair_chain", "ag4_host_fraction", "dt1_verdict", "rj4_apply_mask", "dt5_site_tiers", "wn18_custody_pairs",
          "rj16_nearest_junction", "dt14_variant_effect", "flagship_insertion_sites", "ag20_pileup_regions", "fl4_subsample_pairs", "cu2_merge_catalogue", "rj24_grna_sites",
          "rj24_guide_table", "rj11_pair_junctions", "ag23_modification_profile", "rj23_kmer_hits", "rj7_homology_filter", "rj20_clean_catalogue", "dt17_merge_contigs",
          "wn2_merge_annotations", "wn3_dedupe_elements", "wn5_filter_overlaps", "wn8_cassettes", "wn4_rank_sites"]


def test_every_operator_has_a_query():
    have = {re.match(r"[a-z]+\d*", n).group(0) for n in entry.queries()}
    assert [i for i in IDS if i not in have] == []


def test_oracles_belong_to_queries():
    names, oracles = set(catalog.queries()), set(catalog.oracle_sql())
    assert oracles <= names and names - oracles <= {"it2_extend_seeds", "cu4_cluster_sequences"}


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, sf, db, name):
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    cur = db.execute(entry.oracle_sql()[name])
    at = [[d[0] for d in cur.description].index(c) for c in cols]
    want = sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=repr)
    assert got == want
