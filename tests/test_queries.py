"""Queries against their SQL in DuckDB, over the smallest driver tables."""

import glob
import os

import duckdb
import pytest

from splicelake.plans.catalogue import ORACLE_SQL, QUERIES

TABLES = "/root/testdata/sf0.001"
SOME = (
    "nonredundant_identical redundant_subset refined_groups consensus_groups antisense_fragments sj_matrix transcripts_sj_supported abundance_labels reannotate_ids scaffold_counts length_percentiles length_outliers "
    "gtf_rows gtf_model utr_regions gtf_tagged sj_files spliced_fasta padded_gtf renamed_gtf deep_structural flat_location other_numbers "
    "fastq_records quantified kept_up_winners sj_counts"
).split()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(map(tuple, df.astype(object).where(df.notna(), None).astype(str).values.tolist())), list(df.columns)


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no driver tables")
@pytest.mark.parametrize("name", SOME)
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, TABLES).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert rows(got) == rows(want) and len(got)
