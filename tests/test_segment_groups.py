from collections import Counter

from lanewright.operators import demand


def test_repeated_keys_are_counted_from_a_row_per_segment_and_weekday(rows, monkeypatch):
    """Slots that come twice, three and four times, unknown and absent slots and types that repeat."""
    written = []

    def counted(df, label, plain=demand.materialise):
        out = plain(df, label)
        written.append(out.count())
        return out

    monkeypatch.setattr(demand, "materialise", counted)
    v = [(s, 3, w, t, 1.0) for s in "abcdef" for w in demand.ts.WEEKDAYS for t in demand.ts.SLOTS]
    v += [("a", 3, "MON", "0000", 1.0)] + [("b", 3, "MON", "0830", 1.0)] * 2 + [("b", 3, "TUE", "0900", 1.0)] * 3 + [("c", 3, "WED", "2330", -1.0), ("c", 3, "WED", "1200", None)]
    v += [("d", 3, "SUN", "0015", 1.0)] * 2 + [("d", 3, "SUN", None, 1.0)] * 3 + [("e", None, "SAT", "0100", 1.0)] * 3 + [("e", 4, None, "0100", 1.0)] * 2 + [(None, 3, "MON", "0000", 1.0)] * 2
    got = {r.rule: r.n for r in demand.segment_violations(rows("segment_id string, type int, dow string, time string, value double", *v), rows("segment_id string, zone_id int", *[(s, 1) for s in "abcdef"])).collect()}
    assert got["duplicate_keys"] == sum(n > 1 for n in Counter(r[:4] for r in v).values()) == 10
    assert (got["negative_values"], got["null_values"], got["wrong_type"], got["unknown_slots"], got["row_count_off"]) == (1, 1 + 3 + 3 + 2 + 2, 2, 2, len(v) - 6 * 336)
    assert "unknown_weekdays" not in got and "uncovered_segments" not in got
    assert written and max(written) < 60
