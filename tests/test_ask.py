import pytest

from sanitaria.operators.ask import Question, QuestionError, allowed_aggregates, ask, diagnose, preview, sample_rows
from sanitaria.operators.predicates import where_rules


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("SP", "M", 10, 1.5), ("SP", "F", 20, 2.5), ("RJ", "M", None, 4.0), (None, "F", 5, None)],
        "uf string, sexo string, idade int, val double",
    )


def test_grouped_question(people):
    result = ask(people, {
        "projections": ["uf", ("idade", "count"), ("val", "sum"), ("sexo", "count_distinct")],
        "group_by": ["uf"], "order_by": ("uf", "ASC"),
    })
    assert result.columns == ["uf", "count_idade", "sum_val", "count_distinct_sexo"]
    assert [tuple(r) for r in result.collect()] == [("RJ", 0, 4.0, 1), ("SP", 2, 4.0, 2), (None, 1, None, 1)]


def test_plain_and_total_questions(people):
    rows = ask(people, {"projections": ["sexo"], "order_by": ("idade", "DESC"), "limit": 2}).collect()
    assert [r.sexo for r in rows] == ["F", "M"]
    assert ask(people, {"projections": [("idade", "max"), ("idade", "min")]}).first() == (20, 5)
    assert ask(people, {"projections": ["uf"], "group_by": ["uf"]}).count() == 3


@pytest.mark.parametrize(
    "spec, keys",
    [
        ({}, ["projections.empty"]),
        ({"projections": ["uf", ("idade", "sum")]}, ["projection.missingGroupBy:uf"]),
        ({"projections": [("uf", "count")], "group_by": ["uf"]}, ["groupBy.conflictsWithAgg:uf"]),
        ({"projections": [("uf", "sum")]}, ["aggregation.notForType:sum_uf"]),
        ({"projections": ["nope"]}, ["column.unknown:nope"]),
    ],
)
def test_malformed_questions(people, spec, keys):
    with pytest.raises(QuestionError) as error:
        ask(people, spec)
    assert error.value.keys == keys


def test_hint_for_group_without_aggregate(people):
    question = Question.of({"projections": ["uf"], "group_by": ["uf"]})
    assert diagnose(question, people.schema).warnings == ["groupBy.noAggregation"]
    assert "sum" not in allowed_aggregates(people.schema["uf"].dataType)


@pytest.mark.parametrize(
    "rule, n",
    [
        (("=", "SP"), 2), (("!=", "SP"), 1), (("in", "SP,RJ"), 3), (("notIn", ["RJ"]), 2), (("null", None), 1),
        (("notNull", None), 3), (("contains", "P"), 2), (("beginsWith", "R"), 1), (("endsWith", "J"), 1),
        (("doesNotContain", "P"), 1), (("doesNotBeginWith", "S"), 1), (("doesNotEndWith", "P"), 1), (("<", "SP"), 1),
        ((">=", "RJ"), 3), (("between", "RJ,SP"), 3), (("notBetween", "SA,SZ"), 1), (("<=", "RJ"), 1), ((">", "RJ"), 2),
    ],
)
def test_rules(people, rule, n):
    operator, value = rule
    assert where_rules(people, {"rules": [{"field": "uf", "operator": operator, "value": value}]}).count() == n


def test_nested_rules(people):
    young = {"field": "idade", "operator": "<", "value": "15"}
    rich = {"field": "val", "operator": ">", "value": "2"}
    assert where_rules(people, {"combinator": "or", "rules": [young, rich]}).count() == 4
    assert where_rules(people, {"combinator": "and", "rules": [{"not": True, "rules": [young]}, rich]}).count() == 1
    assert where_rules(people, {"rules": []}).count() == 4
    with pytest.raises(ValueError):
        where_rules(people, {"rules": [{"field": "uf", "operator": "like", "value": "x"}]})


def test_preview(spark):
    spark.range(50).createOrReplaceTempView("fifty")
    exact = preview(spark, "select * from fifty", limit=50)
    assert (exact.row_count, exact.truncated, exact.total_rows) == (50, False, None)
    cut = preview(spark, "select * from fifty", limit=20)
    assert (cut.row_count, cut.truncated, cut.total_rows, cut.columns) == (20, True, 50, ["id"])
    assert preview(spark, "select * from fifty limit 5").row_count == 5


def test_sample(spark):
    assert sample_rows(spark.range(100), 10).count() == 10
    assert sample_rows(spark.range(5), 10).count() == 5
