from tests.conftest import DATA
from visitgraph.operators import evidence as E
from visitgraph.operators.index import first_wins
from visitgraph.operators.tables import settled
from visitgraph.sources.fixtures import readings, work_records


def test_votes_and_consensus_move_readings_once(spark):
    keys = E.keyed(settled(readings(spark, DATA)))
    for d in (E.votes(keys), E.stable(E.votes(keys)), E.scalar_consensus(keys), E.list_consensus(keys), E.crosspage_conflicts(keys.where("field <> ''"))):
        d.collect()
        plan = d._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
        assert moved and all("hashpartitioning(doc_id" in line and "REPARTITION_BY_COL" in line for line in moved)


def test_first_rows_are_those_that_win(spark):
    every, first = work_records(spark, DATA), work_records(spark, DATA, first=True)
    assert every.count() > first.count() == first_wins(every).count()
    assert first_wins(every).exceptAll(first).isEmpty() and first.exceptAll(first_wins(every)).isEmpty()
