"""Run reports: Markdown and JSON of metric rows."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping

log = logging.getLogger(__name__)


class Report:
    def __init__(self, title: str):
        self.lines, self.data = [f"# {title}", ""], {}

    def heading(self, text: str) -> None:
        self.lines += [f"## {text}", ""]

    def text(self, text: str) -> None:
        self.lines += [text, ""]

    def table(self, head: list[str], rows: list[list]) -> None:
        cell = lambda x: "" if x is None else str(x).replace("|", "\\|")
        self.lines += ["| " + " | ".join(map(cell, head)) + " |", "|" + " --- |" * len(head)]
        self.lines += ["| " + " | ".join(map(cell, r)) + " |" for r in rows] + [""]

    def metrics(self, stage: str, values: Mapping) -> None:
        """A stage's one-row metrics, as a table and under its name in the JSON."""
        self.heading(stage)
        self.table(["metric", "value"], [[k, v] for k, v in values.items()])
        self.data[stage] = dict(values)
        log.info("%s: %s", stage, ", ".join(f"{k} {v}" for k, v in values.items() if k != "sample"))
        log.debug("%s: %s", stage, json.dumps(self.data[stage], ensure_ascii=False, default=str))

    def markdown(self) -> str:
        return "\n".join(self.lines) + "\n"

    def json(self) -> str:
        return json.dumps(self.data, ensure_ascii=False, indent=2, default=str)

    def write(self, markdown: str, as_json: str, step_summary: str | None = None) -> None:
        for path, text, mode in ((markdown, self.markdown(), "w"), (as_json, self.json(), "w"), (step_summary, self.markdown(), "a")):
            if path:
                with open(path, mode, encoding="utf-8") as file:
                    file.write(text)
