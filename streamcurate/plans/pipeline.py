"""From streams to a split, audited package: alignment, cleaning, windows, QC and packaging in one plan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..functions.storage import materialize
from ..operators import clean as cl
from ..operators import package as pk
from ..operators import qc, sync
from ..operators import windows as wn


@dataclass
class PipelineConfig:
    reference: str | float = "imu"
    tolerance_ms: float = 100.0
    methods: dict[str, str] = field(default_factory=dict)
    corrections: dict[str, tuple[float, float]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    window: int = 100
    stride: int = 100
    drop_incomplete: bool = True
    features: dict[str, dict] = field(default_factory=dict)
    minimum_samples: int = 1
    ratios: tuple[float, float, float] = (0.8, 0.1, 0.1)
    grouping: str = "overlap"
    strategy: str = "hash"
    seed: int = 42
    bucket_us: int | str | None = "auto"


@dataclass
class PipelineResult:
    rows: DataFrame
    dropped: DataFrame
    samples: DataFrame
    issues: DataFrame
    report: DataFrame
    audit: DataFrame
    stats: DataFrame
    status: DataFrame


def run(streams: dict[str, DataFrame], config: PipelineConfig) -> PipelineResult:
    """Results feed several reports where they are written once: after alignment and after the windows."""
    aligned = materialize(sync.synchronize(streams, config.reference, config.methods, config.tolerance_ms, config.corrections, config.bucket_us), "aligned")
    kept, dropped = cl.split(materialize(cl.judged(aligned, required=list(config.required)), "judged"))
    windowed = wn.count_windows(kept, config.window, config.stride, config.drop_incomplete)
    samples = materialize(wn.transform(windowed, config.features), "samples")
    issues, report = qc.qc_report(samples, config.minimum_samples)
    packed = pk.package(samples, config.ratios, config.grouping, config.strategy, config.seed)
    return PipelineResult(aligned, dropped, packed.samples, issues, report, packed.audit, packed.stats, packed.status)
