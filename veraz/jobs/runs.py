"""One run of a job: its window of days, its state and the results of its rules."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veraz.jobs.store import Store
from veraz.operators import quality
from veraz.sources import files

STATE, RESULTS = "ops.pipeline_state", "ops.quality_results"
_STATE = "pipeline_id string, recorte_id string, watermark_concluido date, sobreposicao_dias int, ultimo_run_id string, atualizado_em timestamp, versao_estado long"
_RESULT = "regra string, severidade string, observados long, total long, limite long, percentual double, status string, run_id string, pipeline_id string, recorte_id string, registrado_em timestamp"


@dataclass(frozen=True)
class Run:
    run_id: str
    end: date
    mode: str = "bootstrap"
    pipeline: str = "nucleo"
    slice_: str = "nacional"
    overlap_days: int = 3

    def state(self, store: Store):
        if not store.exists(STATE):
            return None
        return store.read(STATE).where((F.col("pipeline_id") == self.pipeline) & (F.col("recorte_id") == self.slice_)).first()

    def window(self, store: Store) -> tuple[date, date] | None:
        """The days that the run reads; None: all. An incremental run needs the watermark of a bootstrap."""
        if self.mode != "incremental":
            return None
        known = self.state(store)
        if known is None or known.watermark_concluido is None:
            raise ValueError("an incremental run needs the watermark of a bootstrap")
        return quality.incremental_window(known.watermark_concluido, self.end, self.overlap_days)

    def advance(self, store: Store) -> date | None:
        """Moves the watermark after a run that has published."""
        known = self.state(store)
        mark = quality.next_watermark(known.watermark_concluido if known else None, self.end, self.mode, True)
        if mark is None:
            return None
        row = (self.pipeline, self.slice_, mark, self.overlap_days, self.run_id, datetime.now(UTC), (known.versao_estado if known else 0) + 1)
        new = store.spark.createDataFrame([row], _STATE)
        if store.exists(STATE):
            others = store.read(STATE).where(~((F.col("pipeline_id") == self.pipeline) & (F.col("recorte_id") == self.slice_)))
            new = others.unionByName(new)
        store.put({STATE: new})
        return mark

    def record(self, store: Store, results: list[quality.RuleResult]) -> None:
        """Keeps the results of the rules, those that failed included; a run that is repeated replaces its own."""
        now = datetime.now(UTC)
        rows = store.spark.createDataFrame([(*asdict(r).values(), self.run_id, self.pipeline, self.slice_, now) for r in results], _RESULT)
        if store.exists(RESULTS):
            same = (F.col("run_id") == self.run_id) & (F.col("pipeline_id") == self.pipeline)
            rows = store.read(RESULTS).where(~same).unionByName(rows, allowMissingColumns=True)
        store.put({RESULTS: rows})


def in_window(rows: DataFrame, window: tuple[date, date] | None, moment: str) -> DataFrame:
    return rows if window is None else files.within_days(rows, moment, *(d.isoformat() for d in window))
