import datetime as dt
import json
import re

import pytest

from tidemark.operators import analytics, charts, report, scoring


def test_report(spark):
    rows = [(i, f"ann {i % 2}: x" if i % 5 else "Bot", f"c{i % 3}", f"text {i} <b>", dt.datetime(2022, 1, 1) + dt.timedelta(days=9 * i)) for i in range(120)]
    m = spark.createDataFrame(rows, "message_id long, author_name string, channel_name string, content string, created_at timestamp_ntz")
    s = analytics.scored(m, scoring.doubled(m))
    page = report.render(s, 2023, 10)
    assert "<b>" not in page.split("</style>")[1] and "Conversation report" in page and "120" in page
    names = {r.author for r in analytics.member_compare(s, 10).collect()}
    assert names == {"ann 0: x", "ann 1: x"}  # the excluded name in mixed case is gone
    assert report.scaled(1, 2, 2) == 50 and report.percent(1, 0) == "–"


def test_inactive_author_has_no_year(spark):
    rows = [(1, "a", "c", "t", dt.datetime(2020, 1, 1)), (2, "b", "c", "t", dt.datetime(2022, 1, 1)), (3, "c", "c", "t", dt.datetime(2021, 1, 1))]
    m = spark.createDataFrame(rows, "message_id long, author_name string, channel_name string, content string, created_at timestamp_ntz")
    got = {r.author: r.n_year for r in analytics.member_compare(analytics.scored(m, scoring.doubled(m)), 1).collect()}
    assert got == {"a": None, "b": 1, "c": 1}  # the cutoff itself counts


def scored_rows(spark, n=60):
    rows = [(i, f"ann {i % 2}", f"c{i % 3}", f"text {i} é", dt.datetime(2021 + i % 3, 1 + i % 12, 1)) for i in range(n)]
    m = spark.createDataFrame(rows, "message_id long, author_name string, channel_name string, content string, created_at timestamp_ntz")
    return analytics.scored(m, scoring.doubled(m))


def test_axis_and_strips_share_one_padded_axis():
    assert report.axis([0.2, None, -0.4], 0.1) == (pytest.approx(-0.5), pytest.approx(0.3)) and report.axis([]) == (-1.0, 1.0)
    page = report._strips([{"author": "a<b", "life": 0.0, "year": 1.0}, {"author": "c", "life": -1.0, "year": None}])
    places = [float(x) for x in re.findall(r"left:([0-9.]+)%", page)]
    low, high = -1.05, 1.05
    assert places == [pytest.approx(100 * (v - low) / (high - low), abs=0.06) for v in (0.0, 1.0, -1.0)] and "a&lt;b" in page


def test_the_page_is_written_with_its_charts(spark, tmp_path):
    s = scored_rows(spark)
    report.write(s, f"file://{tmp_path}/deep/page.html", 2021, 5)
    page = (tmp_path / "deep/page.html").read_text(encoding="utf-8")
    assert page == report.render(s, 2021, 5) and "é" in page
    data, drawings = json.loads(re.search(r"id='charts'>(.*?)</script>", page)[1]), re.findall(r"<svg.*?</svg>", page)
    assert len(drawings) == 4 and data == report.chart_data(s, 2021)
    assert drawings[0].count("<path") == len([p for p in data["polarity"] if p[1]]) and sum(n for _, n in data["polarity"]) == 60
    assert drawings[1].count("<circle") == len(data["years"]) == 3 and drawings[2].count("<circle") == len(data["months"]) and drawings[3].count("<rect") == len(data["channels"]) == 3
    want = {str(y): v for y, v in ((r.yr, r.avg_score) for r in analytics.by_year(s).collect())}
    assert dict(data["years"]) == {y: pytest.approx(v, abs=1e-4) for y, v in want.items()}


def test_charts_of_odd_series():
    assert all("no data" in c("t", []) for c in (charts.doughnut, charts.line, charts.bars)) and "no data" in charts.line("t", [["a", None]])
    one = charts.doughnut("<t>", [["all", 5]])
    assert one.count("<path") == 1 and "100.0%" in one and "&lt;t&gt;" in one
    gap = charts.line("t", [["a", 1.0], ["b", None], ["c", 2.0], ["d", 3.0]])
    assert gap.count("<polyline") == 2 and gap.count("<circle") == 3
    down = charts.bars("t", [["a", -1.0], ["b", 1.0], ["c", None]])
    heights = [float(x) for x in re.findall(r"height='([0-9.]+)' fill", down)]
    assert len(heights) == 2 and heights[0] == pytest.approx(heights[1])


def test_profile_charts(spark):
    m = spark.createDataFrame([(n, dt.datetime(2020 + n % 2, 1, 1)) for n in (0, 1, 10, 299, 300, 5000)], "content_len int, created_at timestamp_ntz")
    page = report.profile_charts(m)
    lengths = re.findall(r"<title>(\d+): (\d+)</title>", page.split("</svg>")[0])
    assert len(lengths) == 40 and sum(int(n) for _, n in lengths) == 6 and lengths[-1][1] == "3" and lengths[0][1] == "2"
    assert report.profile_charts(m.limit(0)).count("no data") == 2
