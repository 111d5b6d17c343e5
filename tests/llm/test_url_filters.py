import datetime as dt

from tessera.llm.url_filters import judge, validity

D = lambda m, d=1: dt.date(2024, m, d)
ENTRIES = [("domain:a.org", D(1), "block", "spam"), ("domain:a.org", D(3), "remove", "spam"), ("host:x.a.org", D(2, 15), "allow", None),
           ("path:x.a.org/ads", D(1, 5), "block", "ads"), ("path:x.a.org/ads", D(1, 5), "allow", "zzz"), ("domain:b.org", D(5), "block", "m"),
           (None, D(1), "block", "x"), ("domain:c.org", None, "block", "x")]


def judged(spark, rows):
    entries = spark.createDataFrame(ENTRIES, "pattern string, listed_on date, action string, category string")
    captures = spark.createDataFrame([(*r, "e") for r in rows], "id long, url string, fetched_on date, _row string")
    return judge(captures, validity(entries))


def test_as_of(spark):
    rows = [(1, "http://a.org/", D(2, 28)), (2, "http://a.org/", D(3)), (3, "http://x.a.org/p", D(2, 14)), (4, "https://X.A.org:80/p?q", D(2, 15)),
            (5, "http://u@x.a.org/ads/1", D(12, 31)), (6, "http://b.org", D(4, 30)), (7, "http://b.org", D(5)), (8, None, D(5)),
            (9, "nonsense", D(5)), (10, "http://b.org", None), (7, "http://b.org", D(5)), (11, "http://c.org", D(6)), (12, "", D(6))]
    got = judged(spark, rows)
    assert got.columns[:4] == ["id", "url", "fetched_on", "_row"] and got.count() == len(rows)
    out = {(r.id, r.verdict, r.pattern, r.valid_from) for r in got.collect()}
    none = {(i, "allow", None, None) for i in (2, 6, 8, 9, 10, 11, 12)}
    assert out == none | {(1, "block", "domain:a.org", D(1)), (3, "block", "domain:a.org", D(1)), (4, "allow", "host:x.a.org", D(2, 15)),
                          (5, "block", "path:x.a.org/ads", D(1, 5)), (7, "block", "domain:b.org", D(5))}


def test_empty(spark):
    assert judged(spark, []).count() == 0
    captures = spark.createDataFrame([(1, "http://a.org", D(1))], "id long, url string, fetched_on date")
    none = spark.createDataFrame([], "pattern string, listed_on date, action string, category string")
    assert [r.verdict for r in judge(captures, validity(none)).collect()] == ["allow"]
