"""Marts kept from partials equal marts rebuilt, over random load sequences."""

import datetime as dt
import random

import pytest

from hirescope.operators import company_mart, heatmap
from hirescope.plans import jobs
from hirescope.plans.queries import _merge_catalog
from hirescope.sources.sinks import MERGE, CatalogTable, merge_into_table

SCHEMA = (
    "job_posting_id string, job_title string, company_name string, job_city string, job_state string, job_seniority_level string, "
    "job_function string, job_posted_date string, job_employment_type string, job_industries string, min_salary double, max_salary double, "
    "enriched_dts timestamp, load_date string"
)
AS_OF = dt.date(2001, 8, 1)


def _batch(rng, load, n):
    pick = rng.choice
    day = lambda: pick([None, "odd", str(AS_OF - dt.timedelta(days=rng.choice([0, 3, 7, 8, 29, 30, 31, 89, 90, 91, 400])))])
    salary = lambda: pick([None, 0.0, 50000.0, 81250.5, 120000.0])
    ids = rng.sample(range(40), n)
    return [
        (str(i), pick(["Engineer", "Analyst", None]), pick(["A", "B", "C", None]), pick(["Sydney", "Perth", None]), pick(["NSW", None]),
         pick(["Entry level", "Director", "Mid-Senior level", None]), pick(["IT", "Ops"]), day(), pick(["Full-time", "Contract", None]), pick(["Tech", None]),
         salary(), salary(), dt.datetime(2001, 7, load), f"2001-07-{load:02d}")
        for i in ids
    ]


def _rows(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_marts_from_partials_equal_a_rebuild(spark, seed):
    rng = random.Random(seed)
    table, path = _merge_catalog(spark)
    kept = {name: CatalogTable(f"{table.name}_{name}") for name in jobs.INCREMENTAL_MARTS}
    rebuilt = {"heatmap": lambda s: heatmap(s, AS_OF), "heatmap_v2": lambda s: heatmap(s, AS_OF, standardise=True), "company_hiring": lambda s: company_mart(s, AS_OF)}
    for load in range(1, 4):
        batch = spark.createDataFrame(_batch(rng, load, rng.choice([0, 3, 15])), SCHEMA)
        gone = spark.createDataFrame([(str(rng.randrange(40)),)], "job_posting_id string")
        merge_into_table(spark, path, batch, ["job_posting_id"], ["load_date"], delete_keys=gone, table=table)
        if load == 2 and seed == 2:
            continue  # two loads between refreshes
        for name, (make, finish) in jobs.INCREMENTAL_MARTS.items():
            partials = jobs.refresh_partials(spark, table, kept[name], f"{path}_{name}", make)
            assert _rows(finish(partials, AS_OF)) == _rows(rebuilt[name](table.read(spark)))


def test_old_partitions_are_not_read_again(spark):
    rng = random.Random(9)
    table, path = _merge_catalog(spark)
    kept, seen = CatalogTable(f"{table.name}_partials"), []
    make, _ = jobs.INCREMENTAL_MARTS["heatmap"]

    def watched(rows, by):
        seen.append({r[0] for r in rows.select("load_date").distinct().collect()})
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and MERGE in plan.split("PartitionFilters: [")[1].split("]")[0]
        return make(rows, by)

    for load in (1, 2, 3):
        new = [(f"{load}-{n}", *row[1:]) for n, row in enumerate(_batch(rng, load, 5))]
        merge_into_table(spark, path, spark.createDataFrame(new, SCHEMA), ["job_posting_id"], ["load_date"], table=table)
        jobs.refresh_partials(spark, table, kept, f"{path}_partials", watched)
    assert seen == [{"2001-07-01"}, {"2001-07-02"}, {"2001-07-03"}]
    jobs.refresh_partials(spark, table, kept, f"{path}_partials", watched)  # nothing new: nothing read
    assert len(seen) == 3
    # a replaced posting: its partition is rewritten, and only that and the new one are read
    merge_into_table(spark, path, spark.createDataFrame([("2-0", *_batch(rng, 4, 1)[0][1:])], SCHEMA), ["job_posting_id"], ["load_date"], table=table)
    jobs.refresh_partials(spark, table, kept, f"{path}_partials", watched)
    assert seen[3] == {"2001-07-02", "2001-07-04"}
