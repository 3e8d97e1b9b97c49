from __future__ import annotations

import pytest

from tests.frames import table, tuples
from trailmark.params import JobParams, ParamError
from trailmark.schemas import TASK
from trailmark.sources.tasks import find_task, task_params

FULL = (
    '{"startDate":["2024-01-01"],"endDate":["2024-01-30"],"startAge":["20"],"endAge":["50"],'
    '"professionals":["HOUSEHOLD,MACHINERY"],"cities":["A,B"],"sex":["male"],'
    '"keywords":["kw1,kw2"],"categoryIds":["1,x,2"],"targetPageFlow":["1,2,3,4"]}'
)


def task(task_id, text):
    return (task_id, "t", None, None, None, "session", "new", text)


def test_all_parameters():
    assert JobParams.from_task_json(FULL, 7) == JobParams(
        task_id=7,
        start_date="2024-01-01",
        end_date="2024-01-30",
        start_age=20,
        end_age=50,
        professionals=("HOUSEHOLD", "MACHINERY"),
        cities=("A", "B"),
        sex="male",
        keywords=("kw1", "kw2"),
        category_ids=(1, 2),
        page_flow=(1, 2, 3, 4),
    )


def test_absent_empty_and_further_elements():
    params = JobParams.from_task_json('{"sex":[],"cities":[""],"keywords":["a","b"]}')
    assert (params.sex, params.cities, params.keywords) == (None, None, ("a",))


def test_list_of_unknown_ids_is_present_but_empty():
    assert JobParams.from_task_json('{"categoryIds":["x"]}').category_ids == ()


@pytest.mark.parametrize("text", [None, "", "bad", "[]", '{"sex":"male"}', '{"startAge":["x"]}'])
def test_unreadable_parameters_raise(text):
    with pytest.raises(ParamError):
        JobParams.from_task_json(text)


def test_page_flow_is_required_and_numeric():
    with pytest.raises(ParamError):
        JobParams().required_page_flow()
    with pytest.raises(ParamError):
        JobParams.from_task_json('{"targetPageFlow":["1,x"]}')


def test_find_task(spark):
    tasks = table(spark, TASK, task(1, FULL), task(2, '{"sex":["male"]}'))
    assert find_task(tasks, 2) == JobParams(task_id=2, sex="male")
    with pytest.raises(ParamError, match="task 3"):
        find_task(tasks, 3)


def test_task_params_as_columns(spark):
    tasks = table(spark, TASK, task(1, '{"sex":["male","x"],"cities":[]}'), task(2, "bad"))
    found = tuples(task_params(tasks), "task_id", "sex", "cities")
    assert found == [(1, "male", None), (2, None, None)]
