"""Export, prepare, merge, check and write.

The exports are written once and read back. They are the hand-off between the heavy scans
and the merge: small, checked, and safe against lost executors.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ValidationError
from ..operators.clean import drop_invalid_installs, match_counts
from ..operators.merge import merged_table
from ..operators.prepare import (
    marketplace_wide,
    prepare_billing,
    prepare_connect,
    prepare_dau,
    prepare_hil_gov,
    prepare_kyc,
    prepare_signups,
    prepare_workflow,
)
from ..operators.quality import Profile, check_profiles, check_windows, date_windows, grain_duplicates, stage_strict
from ..sources.contracts import EXPORTS, require_columns
from ..sources.readers import read_export, read_optional, read_with_fallback
from ..sources.staging import stage
from ..sources.writers import read_by_week, write_long, write_merged
from .jobs import Settings, job_group, select_jobs

log = logging.getLogger(__name__)

PREPARE = {
    "workflow": prepare_workflow,
    "billing": prepare_billing,
    "dau": prepare_dau,
    "connect": prepare_connect,
    "kyc": prepare_kyc,
    "hil_gov": prepare_hil_gov,
    "marketplace": marketplace_wide,
    "signups": prepare_signups,
}
OPTIONAL_EXPORTS = ("kyc", "hil_gov", "marketplace")


class Exports(dict[str, DataFrame]):
    """Exports by name; ``profiles`` has those that were checked while they were written."""

    def __init__(self, frames: Mapping[str, DataFrame] = {}, profiles: Mapping[str, Profile] = {}) -> None:
        super().__init__(frames)
        self.profiles = dict(profiles)


def stage_exports(jobs: Mapping[str, DataFrame], concurrent: int = 4) -> Exports:
    """Run the weekly queries and hand over their written results, checked by the jobs that write them.

    The queries are independent Spark jobs; submitting a few at a time lets one fill the
    executors while another finishes its last tasks.
    """

    def one(name: str) -> tuple[DataFrame, Profile]:
        # An export that lacks columns is found out when it is prepared.
        return stage_strict(jobs[name], [m for m in EXPORTS[name].strict if m in jobs[name].columns], name)

    with ThreadPoolExecutor(max_workers=concurrent) as pool:
        staged = dict(zip(jobs, pool.map(one, jobs)))
    return Exports({n: df for n, (df, _) in staged.items()}, {n: profile for n, (_, profile) in staged.items()})


def stage_with_fallback(
    spark: SparkSession, jobs: Mapping[str, DataFrame], folder: str, allow_fallback: bool = False
) -> Exports:
    """As ``stage_exports``, but a failing licence query may use the export in ``folder``."""
    staged = stage_exports({n: q for n, q in jobs.items() if n != "connect"})
    if "connect" in jobs:
        contract, profiles = EXPORTS["connect"], staged.profiles

        def keep(df: DataFrame, name: str) -> DataFrame:
            written, profiles[name] = stage_strict(df, contract.strict, name)
            return written

        staged["connect"] = read_with_fallback(
            lambda: jobs["connect"],
            lambda: read_export(spark, folder, contract),
            contract.required,
            "connect",
            allow_fallback,
            keep,
        )
    return staged


def write_exports(exports: Mapping[str, DataFrame], folder: str) -> None:
    """Save exports under their contract names, for a later merge-only run."""
    for name, df in exports.items():
        keys = [c for c in EXPORTS[name].grain if c in df.columns]
        df.orderBy(*keys).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}_weekly")


def read_exports(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Exports saved earlier. Verification and marketplace exports may be absent."""
    exports = {}
    for name, contract in EXPORTS.items():
        if name in OPTIONAL_EXPORTS:
            exports[name] = read_optional(spark, folder, contract.candidates, contract.struct, contract.required)
        else:
            exports[name] = read_export(spark, folder, contract)
    return exports


def prepare_exports(exports: Mapping[str, DataFrame], concurrent: int = 4) -> dict[str, DataFrame]:
    """Prepared frames in merge order; each export is checked against its contract.

    Exports that were checked while they were written aren't read for that. Other checks and the
    look-up of plan, app and status names are small jobs of their own, so they too are submitted a
    few at a time.
    """
    names, profiles = [n for n in PREPARE if n in exports], getattr(exports, "profiles", {})

    def one(name: str) -> DataFrame:
        return PREPARE[name](require_columns(exports[name], EXPORTS[name].required, name), checked=name in profiles)

    with ThreadPoolExecutor(max_workers=concurrent) as pool:
        return dict(zip(names, pool.map(one, names)))


def merge_prepared(prepared: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    """Merged table of prepared frames; sign-ups are attached, all others merged."""
    frames = [df for name, df in prepared.items() if name != "signups"]
    return merged_table(frames, prepared["signups"], settings.as_of, settings.include_today)


def merge_exports(exports: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    return merge_prepared(prepare_exports(exports), settings)


def export_grain(exports: Mapping[str, DataFrame]) -> DataFrame:
    """One row per export: its rows that repeat another row's declared key."""
    counted = [
        grain_duplicates(df, EXPORTS[name].grain).select(F.lit(name).alias("source"), "duplicate_rows")
        for name, df in exports.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def check_exports(exports: Mapping[str, DataFrame]) -> None:
    """Fail when an export repeats a key of its grain."""
    repeated = {r["source"]: r["duplicate_rows"] for r in export_grain(exports).collect() if r["duplicate_rows"]}
    if repeated:
        listed = ", ".join(f"{name}: {rows} rows repeat the key of another" for name, rows in repeated.items())
        raise ValidationError(listed)


def run_group(
    jobs: Mapping[str, DataFrame], group: str, folder: str, allow_fallback: bool = False, earlier: str | None = None
) -> Exports:
    """Run the queries of a group, check them, and save their exports in ``folder``.

    With ``allow_fallback`` a failing licence query takes the export saved in ``earlier``, by default
    the one in ``folder``.
    """
    chosen = select_jobs(jobs, job_group(group))
    exports = stage_with_fallback(_session(jobs), chosen, earlier or folder, allow_fallback)
    check_exports(exports)
    write_exports(exports, folder)
    return exports


def _session(jobs: Mapping[str, DataFrame]) -> SparkSession:
    return next(iter(jobs.values())).sparkSession


def run_weekly(
    jobs: Mapping[str, DataFrame],
    settings: Settings,
    path: str,
    fmt: str = "parquet",
    allow_fallback: bool = False,
    earlier: str | None = None,
    mapping: DataFrame | None = None,
    installs: DataFrame | None = None,
) -> DataFrame:
    """The whole run: stage exports, check grain and windows, merge, write.

    ``earlier`` is a folder of saved exports that ``allow_fallback`` may use for the licences. With raw
    ``installs`` and their ``mapping`` the log tells how many installations have no company. Returns
    the merged table by week as written to ``path``; for CSV as staged, before formatting.
    """
    exports = stage_with_fallback(_session(jobs), jobs, earlier or path, allow_fallback)
    check_exports(exports)
    if set(exports) <= set(exports.profiles):
        check_profiles(exports.profiles, settings.strict_windows)
    else:
        check_windows(date_windows(exports), settings.strict_windows)
    if installs is not None and mapping is not None:
        counts = match_counts(drop_invalid_installs(installs), mapping).first()
        log.info("installations with a company: %d, without: %d", counts["matched"], counts["unmatched"])
    merged = stage(merge_exports(exports, settings), "merged")
    write_merged(merged, path, fmt)
    if "marketplace" in exports:
        write_long(exports["marketplace"], f"{path.rstrip('/')}_marketplace_long", fmt)
    return read_by_week(merged.sparkSession, path, merged.schema) if fmt == "parquet" else merged
