"""Folders of one lake. Every layer is a separate root, so no job overwrites its input."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LakePaths:
    root: str

    def _under(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw(self) -> str:
        return self._under("raw", "events")

    @property
    def errors(self) -> str:
        return self._under("raw", "errors")

    @property
    def landed_days(self) -> str:
        """Which days each landing batch wrote to."""
        return self._under("raw", "landed-days")

    @property
    def landed_batches(self) -> str:
        """What each landing batch wrote, and what made it due."""
        return self._under("raw", "landed-batches")

    @property
    def raw_files(self) -> str:
        """Which raw files each run of incremental curation saw first."""
        return self._under("staging", "raw-files")

    @property
    def quarantine(self) -> str:
        return self._under("staging", "quarantine")

    @property
    def quality_results(self) -> str:
        return self._under("staging", "quality-results")

    @property
    def metrics(self) -> str:
        return self._under("staging", "metrics")

    @property
    def outcomes(self) -> str:
        """How the steps of each run ended."""
        return self._under("staging", "outcomes")

    @property
    def totals(self) -> str:
        """Additive totals of each curated day."""
        return self._under("curated", "totals")

    @property
    def distinct(self) -> str:
        """Sets that distinct counts are made of, and the numbers of their members."""
        return self._under("curated", "distinct")

    @property
    def alarm_history(self) -> str:
        """The state of every alarm in every period that was judged."""
        return self._under("staging", "alarm-history")

    @property
    def alarm_calls(self) -> str:
        """Until when alarms were to be judged, run by run."""
        return self._under("staging", "alarm-calls")

    @property
    def curated(self) -> str:
        return self._under("curated", "events")

    @property
    def dataset(self) -> str:
        return self._under("curated", "dashboard")

    @property
    def query_results(self) -> str:
        return self._under("query-results")

    @property
    def catalog(self) -> str:
        """Empty folders of the databases; the tables are external."""
        return self._under("catalog")
