"""What a table looks like: its columns, labels, seed and thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Texts that the CSV reader of pandas takes as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

SEED = 42
TEST_SHARE = 0.2
SKEW_LIMIT = 1.5
IMBALANCE_LIMIT = 2.0


@dataclass(frozen=True)
class TableSpec:
    """Names and settings the operators need; every one of them can be replaced."""

    numeric: tuple[str, ...]
    target: str
    labels: dict[str, int] = field(hash=False)
    id_columns: tuple[str, ...] = ()
    bands: tuple[str, ...] = ()
    differences: tuple[tuple[str, str], ...] = ()
    factor: str | None = None
    factor_differences: tuple[tuple[str, str], ...] = ()
    minority_label: str | None = None
    seed: int = SEED
    test_share: float = TEST_SHARE
    skew_limit: float = SKEW_LIMIT
    imbalance_limit: float = IMBALANCE_LIMIT

    @property
    def label_order(self) -> list[int]:
        return sorted(set(self.labels.values()))

    @property
    def required(self) -> list[str]:
        return [*self.numeric, self.target]

    def with_(self, **changes) -> "TableSpec":
        return replace(self, **changes)


# Columns, labels and derived features of the sky object table.
SKY_OBJECTS = TableSpec(
    numeric=("alpha", "delta", "u", "g", "r", "i", "z", "redshift"),
    target="class",
    labels={"STAR": 0, "GALAXY": 1, "QSO": 2},
    id_columns=(
        "obj_ID", "run_ID", "rerun_ID", "cam_col", "field_ID", "spec_obj_ID", "plate", "MJD", "fiber_ID",
    ),
    bands=("u", "g", "r", "i", "z"),
    differences=(
        ("u", "g"), ("g", "r"), ("r", "i"), ("i", "z"), ("u", "r"), ("g", "i"), ("g", "z"), ("r", "z"), ("u", "z"),
    ),
    factor="redshift",
    factor_differences=(("u", "g"), ("g", "r"), ("r", "i"), ("i", "z"), ("g", "z")),
    minority_label="QSO",
)
