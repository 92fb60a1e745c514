"""Several writers of one dataset: one version follows each version, no row is lost or doubled."""

import os

import pytest
from frames import observations

from tidemark import DatasetSpec, SeriesStore, check_consistency, publish, run_ingest
from tidemark.plans.publish import NO_ROWS

KEYS = ("obs_time", "internal_series_code")
V1, V2, V3, V4 = (f"2024-01-0{n}T00-00-00" for n in range(1, 5))


def rows(spark, *days):
    return observations(spark, [(f"2024-0{m}-0{d}", "A", float(d)) for m, d in days])


class Overtaken(SeriesStore):
    """A store whose first commits come after those of the others given."""

    def __init__(self, spark, root, others):
        super().__init__(spark, root, "d")
        self.others = list(others)

    def append_manifest(self, *args, **kwargs):
        if self.others:
            self.others.pop(0)()
        return super().append_manifest(*args, **kwargs)


def writer(spark, root, version, expected, *days):
    def go():
        assert publish(SeriesStore(spark, root, "d"), rows(spark, *days), version, KEYS, expected).published

    return go


def state(spark, root):
    store = SeriesStore(spark, root, "d")
    found = [(r.obs_time.month, r.obs_time.day, r.version) for r in store.events().collect()]
    assert check_consistency(store).first().consistent
    assert store.index().count() == store.rows_total() == len(found) == len({f[:2] for f in found})
    return sorted(found)


@pytest.mark.parametrize("expected", [None, V1])
def test_the_loser_leaves_out_what_the_winner_added(spark, root, expected):
    if expected:
        writer(spark, root, V1, None, (1, 1))()
    store = Overtaken(spark, root, [writer(spark, root, V2, expected, (1, 2), (2, 3))])
    result = publish(store, rows(spark, (1, 2), (2, 4), (3, 5)), V3, KEYS, expected)
    assert result.published and result.rows_added == 2 and result.months == ((2024, 2), (2024, 3))
    first = [(1, 1, V1)] if expected else []
    assert state(spark, root) == [*first, (1, 2, V2), (2, 3, V2), (2, 4, V3), (3, 5, V3)]
    assert store.versions() == ([V1] if expected else []) + [V2, V3]
    assert not os.path.exists(store.path("staging", f"version={V3}"))


def test_one_overtaken_twice_and_one_left_with_nothing(spark, root):
    writer(spark, root, V1, None, (1, 1))()
    store = Overtaken(spark, root, [writer(spark, root, V2, V1, (1, 2)), writer(spark, root, V3, V2, (1, 3))])
    assert publish(store, rows(spark, (1, 2), (1, 3), (1, 4)), V4, KEYS, V1).rows_added == 1
    assert state(spark, root) == [(1, 1, V1), (1, 2, V2), (1, 3, V3), (1, 4, V4)]


def test_the_rest_may_be_empty(spark, root):
    store = Overtaken(spark, root, [writer(spark, root, V2, None, (1, 2))])
    assert publish(store, rows(spark, (1, 2)), V3, KEYS, None).reason == NO_ROWS
    assert state(spark, root) == [(1, 2, V2)]
    assert not os.path.exists(store.path("events", f"version={V3}"))


def test_an_earlier_label_and_the_last_attempt_give_up(spark, root):
    store = Overtaken(spark, root, [writer(spark, root, V2, None, (1, 2))])
    lost = publish(store, rows(spark, (1, 3)), V1, KEYS, None)
    assert not lost.published and V2 in lost.reason
    store = Overtaken(spark, root, [writer(spark, root, V3, V2, (1, 4))])
    lost = publish(store, rows(spark, (1, 3)), V4, KEYS, V2, attempts=1)
    assert not lost.published and V3 in lost.reason
    assert state(spark, root) == [(1, 2, V2), (1, 4, V3)]
    assert sorted(os.listdir(store.path("events"))) == [f"version={V2}", f"version={V3}"]
    assert os.listdir(store.path("staging")) == []


def test_a_version_has_one_successor(spark, root):
    writer(spark, root, V1, None, (1, 1))()
    store, other = SeriesStore(spark, root, "d"), SeriesStore(spark, root, "d")
    for version in (V2, V3):
        store.write_events(version, rows(spark, (2, 2)))
    schema = rows(spark, (2, 2)).schema
    committed = [
        s.append_manifest(v, s.stats_of(v, schema), 2, schema, KEYS, None, None or s.current_manifest().created_at, None, V1)
        for s, v in ((store, V2), (other, V3))
    ]
    assert committed == [True, False]
    assert store.versions() == other.versions() == [V1, V2]
    assert sorted(n for n in os.listdir(store.path("manifests")) if not n.startswith(".")) == [
        f"after-{V1}.parquet",
        "first.parquet",
    ]


def test_a_whole_run_that_is_overtaken(spark, root, monkeypatch):
    spec = DatasetSpec("d", KEYS, frequency="D")
    run_ingest(spark, spec, rows(spark, (1, 1)), root, version=V1)
    others = [writer(spark, root, V2, V1, (1, 2), (1, 5))]
    plain = SeriesStore.append_manifest

    def append(self, *args, **kwargs):
        if others:
            others.pop()()
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(SeriesStore, "append_manifest", append)
    result = run_ingest(spark, spec, rows(spark, (1, 1), (1, 2), (1, 3)), root, version=V3)
    assert result.published and result.rows_added == 1
    assert state(spark, root) == [(1, 1, V1), (1, 2, V2), (1, 3, V3), (1, 5, V2)]
    days = [r.obs_time.day for r in SeriesStore(spark, root, "d").projections().collect()]
    assert sorted(days) == [1, 2, 3, 5]
