"""State of the latest versions as the keys grow."""

import json

from test_latest_stream import Feed


def test_state_is_one_value_for_a_group_of_keys(spark, tmp_path):
    feed = Feed(spark, tmp_path, groups=4)
    data = [(k, "2020-01-02", k) for k in range(200)]
    query, got = feed.run(data)
    assert len(got) == 200
    held = [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(held) <= 8  # four values and their times to live
    _, got = feed.run([(1, "2020-01-01", -1), (2, "2020-01-03", -2), (200, None, -3)])
    assert sorted(got) == [(k, -2 if k == 2 else k) for k in range(200)] + [(200, -3)]
