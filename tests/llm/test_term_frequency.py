from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ferrograph.llm.term_frequency import mark_extremes, term_frequency

LISTS = st.lists(st.one_of(st.none(), st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "A", "", " ", "　", "á", "á", "x" * 500])), max_size=6)), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(LISTS)
def test_counts_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "row_id int, kw array<string>")
    got = {r.term: (r.occurrences, r.records) for r in term_frequency(df, "kw").collect()}
    occurrences, records = Counter(), Counter()
    for r in rows:
        kept = [x for x in r or [] if x is not None and x.strip()]
        occurrences.update(kept)
        records.update(set(kept))
    assert got == {k: (n, records[k]) for k, n in occurrences.items()}


def test_marks_and_extra_columns(spark):
    rows = [(["hot", "hot"], 1, "m")] * 97 + [(["cold"], 2, "m")] * 2 + [(None, 3, "m")]
    df = spark.createDataFrame(rows, "kw array<string>, term int, mark string")
    got = {(r.term, r.mark, r.records, r.occurrences) for r in mark_extremes(term_frequency(df, "kw"), df).collect()}
    assert got == {("hot", "common", 97, 194), ("cold", "rare", 2, 2)}


def test_small_tables(spark):
    empty = spark.createDataFrame([], "kw array<string>")
    assert mark_extremes(term_frequency(empty, "kw"), empty).collect() == []
    one = spark.createDataFrame([(["x"],)], "kw array<string>")
    assert {r.mark for r in mark_extremes(term_frequency(one, "kw"), one).collect()} == {"rare", "common"}


def test_partial_counts_before_the_shuffle(spark):
    df = spark.createDataFrame([(["x"],)], "kw array<string>")
    plan = term_frequency(df, "kw")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.count("Exchange") == 1
