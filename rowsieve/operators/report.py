"""The data behind a quality report, as DataFrames.

Rendering (HTML, charts) is left to the caller; every data set here is a
small aggregate or a bounded top-k, computed on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.operators.stats import failed_rules_summary, summary, violations
from rowsieve.operators.validate import ValidationResult, qcol


def record_distribution(result: ValidationResult) -> DataFrame:
    """``status`` (passed / rejected), ``records``, ``total_records``."""
    s = summary(result)
    return s.select(
        F.inline(
            F.array(
                F.struct(F.lit("passed").alias("status"), F.col("passed_records").alias("records")),
                F.struct(F.lit("rejected").alias("status"), F.col("rejected_records").alias("records")),
            )
        ),
        F.col("total_records"),
    )


def violations_ranking(result: ValidationResult) -> DataFrame:
    """Every rule by ``failed_count`` descending, ties by rule name."""
    return violations(result).select("rule", "failed_count").orderBy(
        F.col("failed_count").desc(), F.col("rule")
    )


def worst_rules(result: ValidationResult, k: int = 5) -> DataFrame:
    """The ``k`` most violated rules (a top-k report; the limit is the
    feature)."""
    return violations_ranking(result).limit(k)


def metric_cards(result: ValidationResult) -> DataFrame:
    """Total, passed, rejected and quality % rounded to 2 decimals."""
    return summary(result).select(
        "total_records",
        "passed_records",
        "rejected_records",
        F.round(F.col("quality_pct"), 2).alias("quality_pct"),
    )


def rejected_sample(result: ValidationResult, keys: Sequence[str], n: int = 10) -> DataFrame:
    """P5: the first ``n`` rejected rows by key (then by rule text, so ties
    on a non-unique key are broken deterministically) with their rules
    joined by ','.  A top-k on the executors: each task keeps ``n`` rows."""
    fr = failed_rules_summary(result, keys)
    text = F.array_join(F.col(result.verdict_col), ",").alias(result.verdict_col)
    return (
        fr.select(*[qcol(k) for k in keys], text)
        .orderBy(*[qcol(k) for k in keys], F.col(result.verdict_col))
        .limit(n)
    )


def report_data(result: ValidationResult, keys: Sequence[str], sample_rows: int = 10) -> dict:
    """P1–P5 on the driver from two jobs: the one-row counts aggregate and a
    ``sample_rows`` top-k.  Both are bounded (rule count, sample size)."""
    from rowsieve.operators.stats import quality_stats

    stats = quality_stats(result)
    ranking = sorted(
        ((name, v["failed_count"]) for name, v in stats["rule_violations"].items()),
        key=lambda kv: (-kv[1], kv[0]),
    )
    sample = []
    if keys:
        first = failed_rules_summary(result, keys).orderBy(*[qcol(k) for k in keys], F.array_join(qcol(result.verdict_col), ","))
        for row in first.limit(sample_rows).collect():
            sample.append({k: row[k] for k in keys} | {"failed_rules": list(row[result.verdict_col])})
    return {"stats": stats, "ranking": ranking, "worst": ranking[:5], "sample": sample, "keys": list(keys)}


def render_html(data: dict, title: str = "Data Quality Report") -> str:
    """Self-contained HTML (inline CSS, no external scripts) for P1–P5."""
    import datetime as _dt
    import html

    esc = html.escape
    s = data["stats"]
    cards = [
        ("Total records", f"{s['total_records']:,}"),
        ("Passed records", f"{s['passed_records']:,}"),
        ("Rejected records", f"{s['rejected_records']:,}"),
        ("Data quality", f"{s['quality_percentage']:.2f}%"),
    ]
    total = max(s["total_records"], 1)
    top = max([c for _, c in data["ranking"]] + [1])

    def bar(label: str, value: int, scale: int, color: str) -> str:
        width = 100.0 * value / scale
        return (
            f'<div class="row"><span class="lbl">{esc(label)}</span>'
            f'<span class="bar" style="width:{width:.1f}%;background:{color}"></span>'
            f'<span class="val">{value:,}</span></div>'
        )

    parts = [
        "<!DOCTYPE html><html lang='en'><head><meta charset='utf-8'>",
        f"<title>{esc(title)}</title><style>",
        "body{font-family:sans-serif;margin:2em;max-width:960px}",
        ".cards{display:flex;gap:1em}.card{border:1px solid #ccc;border-radius:6px;padding:1em;flex:1}",
        ".card h3{margin:0;font-size:.9em;color:#555}.card p{font-size:1.6em;margin:.3em 0 0}",
        ".row{display:flex;align-items:center;gap:.5em;margin:.2em 0}.lbl{width:16em}",
        ".bar{display:inline-block;height:1em}.val{min-width:5em}",
        "table{border-collapse:collapse;margin-top:.5em}td,th{border:1px solid #ddd;padding:.3em .6em;text-align:left}",
        "</style></head><body>",
        f"<h1>{esc(title)}</h1><p>Generated on {_dt.datetime.now():%Y-%m-%d %H:%M:%S}</p>",
        "<div class='cards'>" + "".join(f"<div class='card'><h3>{k}</h3><p>{v}</p></div>" for k, v in cards) + "</div>",
        "<h2>Record distribution</h2>",
        bar("Passed", s["passed_records"], total, "#2e7d32"),
        bar("Rejected", s["rejected_records"], total, "#c62828"),
        "<h2>Rule violations</h2>",
        *[bar(name, count, top, "#ef6c00") for name, count in data["ranking"]],
        "<h2>Top 5 rule violations</h2><table><tr><th>Rule</th><th>Violations</th></tr>",
        *[f"<tr><td>{esc(n)}</td><td>{c:,}</td></tr>" for n, c in data["worst"]],
        "</table>",
    ]
    if data["sample"]:
        keys = data["keys"]
        parts.append("<h2>Sample rejected records</h2><table><tr>")
        parts.append("".join(f"<th>{esc(k)}</th>" for k in keys) + "<th>Failed rules</th></tr>")
        for row in data["sample"]:
            rules = "<br>".join(esc(r) for r in row["failed_rules"])
            parts.append("<tr>" + "".join(f"<td>{esc(str(row[k]))}</td>" for k in keys) + f"<td>{rules}</td></tr>")
        parts.append("</table>")
    parts.append("</body></html>")
    return "\n".join(parts)


def write_html_report(
    result: ValidationResult, output_path: str, keys: Sequence[str] = (), title: str = "Data Quality Report"
) -> str:
    """Render P1–P5 to ``output_path`` on the driver; returns the path."""
    text = render_html(report_data(result, keys), title)
    with open(output_path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return output_path
