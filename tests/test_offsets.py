"""Missing offsets, and the readers' setting for them."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from centstream.operators.offsets import offset_gaps
from centstream.settings import JobSettings
from centstream.sources import bus

from .test_settings import ENV

DDL = "topic STRING, partition INT, offset BIGINT"


def gaps(spark, rows, width):
    found = offset_gaps(spark.createDataFrame(rows, DDL), width).collect()
    return sorted(tuple(row) for row in found)


def plain(rows):
    found = []
    for key in {row[:2] for row in rows}:
        offsets = sorted({row[2] for row in rows if row[:2] == key})
        for one, two in zip(offsets, offsets[1:], strict=False):
            if two - one > 1:
                found.append((*key, one + 1, two - 1, two - one - 1))
    return sorted(found)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(0, 2), st.integers(0, 60)), max_size=80
    ),
    st.sampled_from([1, 7, 1000]),
)
def test_gaps_are_those_of_sorted_offsets(spark, rows, width):
    assert gaps(spark, rows, width) == plain(rows)


def test_whole_ranges_can_be_missing(spark):
    rows = [("t", 0, 3), ("t", 0, 95), ("t", 0, 95), ("t", 1, 7), ("t", None, 9), ("t", 0, None)]
    assert gaps(spark, rows, 10) == [("t", 0, 4, 94, 91)]
    assert gaps(spark, [], 10) == []


@pytest.mark.parametrize("text, wanted", [("true", "true"), ("false", "false"), (None, "false")])
def test_failing_on_lost_records_is_a_setting(text, wanted):
    env = ENV if text is None else ENV | {"FAIL_ON_DATA_LOSS": text}
    chosen = JobSettings.from_environment(env).fail_on_data_loss
    options = bus.kafka_options("broker:9092", "t", fail_on_data_loss=chosen)
    assert options["failOnDataLoss"] == wanted
