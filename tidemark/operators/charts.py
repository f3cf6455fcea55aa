"""Charts as SVG text, drawn from small collected series. A chart of nothing says so."""

from __future__ import annotations

import html
import math
from collections.abc import Sequence

WIDTH, HEIGHT, PAD = 460, 220, 40
COLOURS = ("#3b7a57", "#b5483a", "#8a8f98", "#c79a3c", "#4a6fa5", "#7d5a94")

Pairs = Sequence[Sequence]


def _frame(title: str, body: str) -> str:
    return f"<svg role='img' aria-label='{html.escape(title, True)}' viewBox='0 0 {WIDTH} {HEIGHT}' width='{WIDTH}' height='{HEIGHT}'><title>{html.escape(title)}</title>{body}</svg>"


def _text(x: float, y: float, text: object, anchor: str = "middle") -> str:
    return f"<text x='{x:.1f}' y='{y:.1f}' font-size='10' text-anchor='{anchor}'>{html.escape(str(text))}</text>"


def _empty(title: str) -> str:
    return _frame(title, _text(WIDTH / 2, HEIGHT / 2, "no data"))


def doughnut(title: str, parts: Pairs) -> str:
    """A ring with an arc for each (name, count), the first at the top and on clockwise, and a legend with shares."""
    total = sum(n for _, n in parts)
    if not total:
        return _empty(title)
    cx, cy, outer, inner, at, body = 105, HEIGHT / 2, 85, 48, 0.0, []
    point = lambda r, a: f"{cx + r * math.sin(2 * math.pi * a):.2f} {cy - r * math.cos(2 * math.pi * a):.2f}"
    for i, (name, n) in enumerate(p for p in parts if p[1]):
        share, colour = n / total, COLOURS[i % len(COLOURS)]
        end = at + min(share, 0.9999)  # a whole ring would begin where it ends
        wide = int(share > 0.5)
        body.append(f"<path d='M {point(outer, at)} A {outer} {outer} 0 {wide} 1 {point(outer, end)} L {point(inner, end)} A {inner} {inner} 0 {wide} 0 {point(inner, at)} Z' fill='{colour}'/>")
        body.append(f"<rect x='225' y='{30 + 20 * i}' width='10' height='10' fill='{colour}'/>" + _text(241, 39 + 20 * i, f"{'none' if name is None else name}: {n:,} ({100 * share:.1f}%)", "start"))
        at += share
    return _frame(title, "".join(body))


def _scale(values: Sequence[float], zero: bool) -> tuple[float, float]:
    low, high = min(values), max(values)
    low, high = (min(low, 0.0), max(high, 0.0)) if zero else (low, high)
    return (low, high) if high > low else (low - 0.5, high + 0.5)


def _y(value: float, low: float, high: float) -> float:
    return HEIGHT - PAD - (HEIGHT - 2 * PAD) * (value - low) / (high - low)


def line(title: str, points: Pairs) -> str:
    """(label, value) in order, joined; a missing value leaves a gap."""
    known = [v for _, v in points if v is not None]
    if not known:
        return _empty(title)
    low, high = _scale(known, False)
    step = (WIDTH - 2 * PAD) / max(1, len(points) - 1)
    runs, run, dots, labels = [], [], [], []
    every = -(-len(points) // 8)
    for i, (label, v) in enumerate(points):
        x = PAD + step * i
        if i % every == 0:
            labels.append(_text(x, HEIGHT - PAD + 15, label))
        if v is None:
            run = []
            continue
        if not run:
            runs.append(run := [])
        run.append(f"{x:.1f},{_y(v, low, high):.1f}")
        dots.append(f"<circle cx='{x:.1f}' cy='{_y(v, low, high):.1f}' r='2.5' fill='{COLOURS[4]}'><title>{html.escape(str(label))}: {v:g}</title></circle>")
    joined = "".join(f"<polyline points='{' '.join(r)}' fill='none' stroke='{COLOURS[4]}' stroke-width='2'/>" for r in runs)
    return _frame(title, _text(PAD - 4, _y(high, low, high) + 3, f"{high:.3g}", "end") + _text(PAD - 4, _y(low, low, high) + 3, f"{low:.3g}", "end") + joined + "".join(dots) + "".join(labels))


def bars(title: str, parts: Pairs) -> str:
    """A bar for each (label, value) from zero, up or down; a missing value has none."""
    known = [v for _, v in parts if v is not None]
    if not known:
        return _empty(title)
    low, high = _scale(known, True)
    step, base, body = (WIDTH - 2 * PAD) / len(parts), _y(0.0, low, high), []
    every = -(-len(parts) // 12)
    for i, (label, v) in enumerate(parts):
        x = PAD + step * i
        if i % every == 0:
            body.append(_text(x + step / 2, HEIGHT - PAD + 15, str(label)[:10]))
        if v is not None:
            top = _y(v, low, high)
            body.append(f"<rect x='{x + step * 0.1:.1f}' y='{min(top, base):.1f}' width='{step * 0.8:.1f}' height='{abs(top - base):.1f}' fill='{COLOURS[0] if v >= 0 else COLOURS[1]}'><title>{html.escape(str(label))}: {v:g}</title></rect>")
    return _frame(title, "".join(body) + f"<line x1='{PAD}' x2='{WIDTH - PAD}' y1='{base:.1f}' y2='{base:.1f}' stroke='#555'/>" + _text(PAD - 4, _y(high, low, high) + 3, f"{high:.3g}", "end"))
