"""DuckDB SQL building blocks of the oracles, stated from the rules rather than from any query.

Each function returns CTE text or an expression that says what a rule means:
membership as EXISTS, precedence as an ordered list, bands as a table.
"""

from __future__ import annotations

from typing import Sequence


def hull_rule(src: str, key: Sequence[str], label: Sequence[str], sid: str, start: str, end: str, out: str) -> str:
    """CTE ``out`` (key, label, start, end): hull rows, and sessions that stick out of a hull or have none.

    A session reaches another of its key if the other starts within it. A
    label's hull begins with its first reaching session and ends with the last
    end among its reaching sessions and the sessions they reach; that end is
    NULL when no session reached has an end (GREATEST with a NULL is NULL).
    """
    cols = lambda t, names: ", ".join(f"{t}.{c}" for c in names)
    same = lambda a, b, names: " AND ".join(f"{a}.{c} = {b}.{c}" for c in names)
    shown = [*key, *label]
    named = f" AND {same('y', 'n', label)}" if label else ""
    return f"""{out}_part AS (
  SELECT {cols('x', shown)}, x.{start}, x.{end}, TRUE AS reaches FROM {src} x
  WHERE EXISTS (SELECT 1 FROM {src} y WHERE {same('y', 'x', key)} AND y.{sid} <> x.{sid}
                AND y.{start} BETWEEN x.{start} AND x.{end})
  UNION ALL
  SELECT {cols('n', shown)}, x.{start}, x.{end}, FALSE
  FROM {src} x JOIN (SELECT DISTINCT {', '.join(shown)} FROM {src}) n ON {same('n', 'x', key)}
  WHERE EXISTS (SELECT 1 FROM {src} y WHERE {same('y', 'x', key)}{named} AND y.{sid} <> x.{sid}
                AND x.{start} BETWEEN y.{start} AND y.{end})),
{out}_hull AS (
  SELECT {', '.join(shown)}, min({start}) FILTER (reaches) AS h0,
         CASE WHEN count({end}) FILTER (NOT reaches) > 0 THEN max({end}) END AS h1
  FROM {out}_part GROUP BY {', '.join(shown)}),
{out} AS (
  SELECT {', '.join(shown)}, h0 AS {start}, h1 AS {end} FROM {out}_hull
  UNION ALL
  SELECT {cols('x', shown)}, x.{start}, x.{end} FROM {src} x JOIN {out}_hull h ON {same('h', 'x', key)}
   AND (x.{start} < h.h0 OR x.{end} > h.h1)
  UNION ALL
  SELECT {cols('x', shown)}, x.{start}, x.{end} FROM {src} x
  WHERE NOT EXISTS (SELECT 1 FROM {out}_hull h WHERE {same('h', 'x', key)}))"""


def first_true(*pairs: tuple[str, str], otherwise: str = "NULL") -> str:
    """The label of the first condition that holds, from an ordered list of (label, condition)."""
    items = ", ".join(f"{{'l': '{label}', 'h': coalesce({cond}, FALSE)}}" for label, cond in pairs)
    return f"coalesce(list_filter([{items}], lambda s: s.h)[1].l, {otherwise})"


def overall_status(title: str, exempt: str, excused: str, waived: str, week: str, pct: str) -> str:
    """Overall status; labels are fixed values."""
    return first_true(("break", f"contains(lower({title}), 'break')"), ("exempted", exempt), ("excused", excused),
                      ("waived", waived), ("attended", f"{week} = 'attended'"),
                      ("attended (attendance percentage under 50%)", f"{pct} < 0.5"), otherwise="'absent'")


#: Phase labels by months since completion, as a table of bands.
PHASE_BANDS = """bands(lo, hi, band) AS (VALUES (0, 6, '0-6 MO. SINCE GRADUATION'), (7, 12, '7-12 MO. SINCE GRADUATION'),
  (13, 18, '13-18 MO. SINCE GRADUATION'), (19, 9999999, 'Concluded'))"""


def phase(months: str) -> str:
    """Phase of a months text: its band's label, or the text itself where no band holds."""
    return f"coalesce((SELECT band FROM bands WHERE TRY_CAST({months} AS BIGINT) BETWEEN lo AND hi), {months})"


def weighted(value: str, weight: str) -> str:
    """Weighted mean with missing numbers as 0, or the plain mean when the weights do not add up to more than 0."""
    return (f"IF(sum(ifnull({weight}, 0)) > 0, sum(ifnull({value}, 0) * ifnull({weight}, 0)) / sum(ifnull({weight}, 0)), "
            f"avg({value}))")


def week_of(day: str, start: str, end: str) -> str:
    """Number of the Monday week of ``day`` in a programme (1 is the week of ``start``; NULL outside), by arithmetic."""
    monday = f"CAST(date_trunc('week', {start}) AS DATE)"
    last = f"CAST(date_trunc('week', {end}) AS DATE)"
    number = f"((CAST(date_trunc('week', {day}) AS DATE) - {monday}) // 7 + 1)"
    return f"CASE WHEN CAST(date_trunc('week', {day}) AS DATE) BETWEEN {monday} AND {last} THEN {number} END"


def week_span(day: str) -> str:
    """'Mon dd - Mon dd' of the Monday week that holds ``day``."""
    monday = f"CAST(date_trunc('week', {day}) AS DATE)"
    return f"strftime({monday}, '%b %d') || ' - ' || strftime({monday} + 6, '%b %d')"
