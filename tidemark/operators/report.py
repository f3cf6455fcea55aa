"""The HTML report: a small template over collected aggregates. No message-level rows are collected but the quotes."""

from __future__ import annotations

import html
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.keyed import write_text

from . import analytics, charts

STYLE = "body{font:15px/1.5 sans-serif;max-width:60em;margin:2em auto}table{border-collapse:collapse}td,th{padding:.2em .8em;text-align:left}.strip{position:relative;height:1em;width:20em;background:#eee}.dot{position:absolute;width:.8em;height:.8em;border-radius:50%}"


def percent(n: float | None, total: float | None) -> str:
    return "–" if not total or n is None else f"{100 * n / total:.1f}%"


def scaled(value: float, low: float, high: float) -> float:
    """Place of a value on an axis in percent; the middle of an axis without extent."""
    return 50.0 if high <= low else max(0.0, min(100.0, 100 * (value - low) / (high - low)))


def axis(values: list[float], pad: float = 0.05) -> tuple[float, float]:
    own = [v for v in values if v is not None]
    return (min(own) - pad, max(own) + pad) if own else (-1.0, 1.0)


def chart_data(scored: DataFrame, since: int) -> dict:
    """Series of the four charts, rounded for display."""
    pairs = lambda df, x, y: [[str(r[x]), round(r[y], 4) if r[y] is not None else None] for r in df.orderBy(x).collect()]
    top = analytics.by_channel(scored).orderBy("n", ascending=False).limit(12)
    return {
        "polarity": [[r["polarity"], r["n"]] for r in analytics.mix(scored, "polarity").orderBy("n", ascending=False).collect()],
        "years": pairs(analytics.by_year(scored), "yr", "avg_score"), "months": pairs(analytics.by_month(scored, since), "ym", "avg_score"),
        "channels": [[r["channel_name"], round(r["avg_score"], 4)] for r in top.collect()],
    }


def _table(head: list[str], rows: list[list]) -> str:
    cells = lambda tag, row: "".join(f"<{tag}>{html.escape(str(x))}</{tag}>" for x in row)
    return f"<table><tr>{cells('th', head)}</tr>" + "".join(f"<tr>{cells('td', r)}</tr>" for r in rows) + "</table>"


def _strips(members: list) -> str:
    low, high = axis([v for m in members for v in (m["life"], m["year"])])
    dot = lambda v, colour: "" if v is None else f"<span class='dot' style='left:{scaled(v, low, high):.1f}%;background:{colour}'></span>"
    return "".join(f"<p>{html.escape(m['author'])}</p><div class='strip'>{dot(m['life'], '#678')}{dot(m['year'], '#d63')}</div>" for m in members)


def takeaways(overview, harsh: int, extremes, toxic_member) -> list[str]:
    """Sentences over the aggregates; what has no value gets none."""
    out = []
    if overview["n"]:
        out.append(f"{overview['n']:,} messages were scored, with a mean polarity of {overview['avg_score']:+.3f}.")
        out.append(f"{percent(harsh, overview['n'])} of them are moderately or severely toxic, {percent(overview['sarcasm_rate'], 1)} sarcastic.")
    if extremes["chillest"] is not None and extremes["chillest"] != extremes["saltiest"]:
        out.append(f"{extremes['chillest']} is the friendliest channel and {extremes['saltiest']} the least friendly.")
    if toxic_member["author"] is not None:
        out.append(f"{toxic_member['author']} has the largest share of toxic messages, {percent(toxic_member['tox_rate'], 1)}.")
    return out


#: Invented lines that show what a context window is.
EXAMPLE = (("ada", "the build is green again"), ("ben", "only after the fourth retry"), ("ada", "sure, totally reliable"))


def example_card(lines: tuple[tuple[str, str], ...] = EXAMPLE) -> str:
    """An invented window: the last line is the one that is judged, the others are its context."""
    shown = [f"<li{' class=target' if i == len(lines) - 1 else ''}>[{html.escape(a)}] {html.escape(t)}</li>" for i, (a, t) in enumerate(lines)]
    return f"<div class='card'><p>The last line is judged with the lines before it as context (invented example).</p><ul>{''.join(shown)}</ul></div>"


def drawn(data: dict) -> str:
    """The four charts of `chart_data`: labels as a doughnut, mean scores by year and by month as lines, by channel as bars."""
    return charts.doughnut("Polarity", data["polarity"]) + charts.line("Mean score by year", data["years"]) + charts.line("Mean score by month", data["months"]) + charts.bars("Mean score by channel", data["channels"])


def profile_charts(messages: DataFrame, most: int = 300, bins: int = 40) -> str:
    """Lengths of the messages, in bins up to `most` characters, the last one with all longer ones; and messages a year."""
    counts = {r["bin"]: r["n"] for r in analytics.length_histogram(messages, most, bins).collect()}
    years = [[str(r["year"]), r["n"]] for r in analytics.messages_per_year(messages).where("year is not null").orderBy("year").collect()]
    lengths = [[str(round(most * k / bins)), counts.get(k, 0)] for k in range(bins)] if counts else []
    return charts.bars("Messages by length", lengths) + charts.bars("Messages by year", years)


def write(scored: DataFrame, path: str, since: int = 2022, least: int = 500) -> None:
    """The page of `render` as one file in UTF-8; a file that is there is replaced."""
    write_text(scored.sparkSession, path, render(scored, since, least))


def render(scored: DataFrame, since: int = 2022, least: int = 500) -> str:
    o, d = analytics.overview(scored).first(), analytics.date_range(scored).first()
    toxic = {r["toxicity"]: r["n"] for r in analytics.mix(scored, "toxicity").collect()}
    harsh = toxic.get("moderate", 0) + toxic.get("severe", 0)
    best = analytics.channel_extremes(scored, least).first()
    members = analytics.by_member(scored).orderBy("tox_rate", ascending=False).limit(15).collect()
    compare = analytics.member_compare(scored, least).orderBy("life", ascending=False).limit(15).collect()
    quotes = analytics.sarcastic_top(scored).collect()
    rooms = analytics.by_channel(scored).where(F.col("n") >= least).orderBy(F.desc("n"), "channel_name").limit(15).collect()
    worst = analytics.most_toxic_member(scored, least).first()
    series = chart_data(scored, since)
    facts = [["messages", f"{o['n']:,}"], ["members", d["members"]], ["channels", d["channels"]], ["from", d["mn"]], ["to", d["mx"]], ["harsh", percent(harsh, o["n"])], ["chillest", best["chillest"]], ["saltiest", best["saltiest"]], ["most sarcastic", best["most_sarcastic"]], ["most toxic member", worst["author"]]]
    body = [
        "<h1>Conversation report</h1>", _table(["fact", "value"], facts), "<h2>Members</h2>",
        _table(["member", "messages", "mean", "sarcastic", "toxic"], [[m["author"], f"{m['n']:,}", f"{m['avg_score']:+.3f}", percent(m["sarcasm_rate"], 1), percent(m["tox_rate"], 1)] for m in members]),
        "<h2>Channels</h2>", _table(["channel", "messages", "mean", "sarcastic", "positive", "negative"], [[c["channel_name"], f"{c['n']:,}", f"{c['avg_score']:+.3f}", percent(c["sarcasm_rate"], 1), c["pos"], c["neg"]] for c in rooms]),
        "<h2>Charts</h2>", drawn(series), "<h2>How a message is judged</h2>", example_card(), "<h2>Takeaways</h2>", *(f"<p class='takeaway'>{html.escape(t)}</p>" for t in takeaways(o, harsh, best, worst)),
        "<h2>Lifetime and last year</h2>", _strips(compare), "<h2>Quotes</h2>", *(f"<blockquote>{html.escape(q['content'])}<br>— {html.escape(q['author'])}</blockquote>" for q in quotes),
        f"<script type='application/json' id='charts'>{json.dumps(series).replace('<', chr(92) + 'u003c')}</script>",
    ]
    return f"<!DOCTYPE html><html lang='en'><head><meta charset='utf-8'><title>Conversation report</title><style>{STYLE}</style></head><body>{''.join(body)}</body></html>"
