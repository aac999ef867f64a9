"""Plain text of a finished job: settings, classes, confusion counts, scores, times, a sample.

Everything shown is already small: the confusion table has at most classes^2 rows
and the summary one row, so collecting them is bounded.
"""

from __future__ import annotations

from tessera.plans.job import JobResult


def _section(title: str, lines) -> list[str]:
    return [title, *(f"  {line}" for line in lines)]


def stats_text(result: JobResult) -> str:
    """Confusion counts by class name, then the summary scores."""
    names = {r.label_idx: r.label for r in result.vocab.collect()}
    counts = result.confusion.orderBy("actual", "predicted").collect()
    pairs = [f"{names.get(r.actual, r.actual)} -> {names.get(r.predicted, r.predicted)}  {r.n}" for r in counts]
    s = result.summary.first()
    scores = [f"{c} {'undefined' if s[c] is None else format(s[c], '.4f')}"
              for c in ("accuracy", "macro_precision", "macro_recall", "macro_f1")]
    return "\n".join(_section("confusion (actual -> predicted)", pairs) + _section("scores", scores))


def report_text(result: JobResult) -> str:
    rep = result.report.first()
    settings = [f"model = {rep.model}", *(f"{k} = {v}" for k, v in sorted(rep.params.items()))]
    classes = [f"{r.label_idx} = {r.label}" for r in result.vocab.orderBy("label_idx").collect()]
    times = [f"training {rep.train_time}", f"test {rep.test_time}", f"whole job {rep.total_time}"]
    lines = _section("settings", settings) + _section("classes", classes) + [stats_text(result)]
    lines += _section("run times", times) + [f"warning: {w}" for w in rep.warnings]
    one = result.sample.first()
    if one is not None:
        lines.append(f"sample: expected {one.expected}, predicted {one.predicted_name}")
    return "\n".join(lines)
