from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone


def new_run_id(now: datetime | None = None) -> str:
    """``YYYYmmdd_HHMMSS_<8 hex>``: the text order of run ids is their time order."""
    now = now or datetime.now(timezone.utc)
    return f"{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


@dataclass(frozen=True)
class RunLayout:
    """Where the artifacts of a run live under a base folder."""

    base: str
    run_id: str

    @property
    def run_folder(self) -> str:
        return f"{self.base}/runs/{self.run_id}"

    def table_data(self, table: str) -> str:
        return f"{self.run_folder}/tables/{table}/data"

    def query(self, engine: str) -> str:
        return f"{self.run_folder}/comparison/queries/{engine}.sql"

    def query_result(self, engine: str) -> str:
        return f"{self.run_folder}/comparison/query_results/{engine}"

    @property
    def report(self) -> str:
        return f"{self.run_folder}/result/comparison_result.json"

    def diagnostic(self, task_id: str) -> str:
        return f"{self.run_folder}/result/diagnostics/{task_id}.json"

    @property
    def diagnostics(self) -> str:
        return f"{self.run_folder}/result/diagnostics/*.json"

    @property
    def runs_table(self) -> str:
        return f"{self.base}/catalog/runs"

    @property
    def pointers_table(self) -> str:
        return f"{self.base}/catalog/pointers"

    def for_run(self, run_id: str) -> "RunLayout":
        return RunLayout(self.base, run_id)
