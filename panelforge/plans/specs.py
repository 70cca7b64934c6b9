"""Declarative specs as dataclasses.

They replace the reference's YAML query / split / model files; a spec drives
``select`` / ``filter`` / ``forecast`` calls in ``plans.pipelines``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# The reference's default windows (daily calendar, inclusive).
DEFAULT_WINDOWS = {
    "context": ("2000-01-03", "2023-01-02"),
    "validation": ("2023-01-03", "2024-01-02"),
    "test": ("2024-01-03", "2024-12-31"),
}
DEFAULT_LEVELS = (0.1, 0.5, 0.9)


@dataclass(frozen=True)
class SplitSpec:
    """Time windows, or with ``partition_by`` each key's own: ``shares`` gives each window's name and
    the share of the key's valued span at which it ends."""
    windows: dict = field(default_factory=lambda: dict(DEFAULT_WINDOWS))
    partition_by: tuple[str, ...] = ()
    all_name: str = "all"
    shares: tuple[tuple[str, float], ...] = (("context", 0.7), ("validation", 0.85), ("test", 1.0))


@dataclass(frozen=True)
class ForecastSpec:
    """One forecast variant."""
    name: str
    # naive | seasonal_naive | mean | drift | trend | ols | pooled_ols | direct | pooled_ar | ridge
    method: str
    horizon: int = 30
    levels: tuple[float, ...] = DEFAULT_LEVELS
    season: int = 7
    covariates: tuple[str, ...] | None = None
    batch_size: int | None = None
    step: str = "day"
    quantile_method: str = "exact"
    lags: tuple[int, ...] = (1, 7)    # pooled_ar
    screen: int | None = None         # ridge: columns kept, None: all
    ridge: float = 0.1


@dataclass(frozen=True)
class QuerySpec:
    """Target entity and variable, covariate entities and variables of a panel query.

    Entities are named by their key or by their label.  Without covariates every
    other column of the dataset's panel is one.
    """
    target: str
    covariates: tuple[str, ...] = ()
    variables: tuple[str, ...] = ()
    dataset: str | None = None
    target_variable: str = "dlyret"


# The reference's three comparison variants (names as in its output).
DEFAULT_VARIANTS = (
    ForecastSpec("no_covariates", "seasonal_naive"),
    ForecastSpec("with_covariates", "ols"),
    ForecastSpec("with_covariates_cross_learning", "pooled_ols", batch_size=100),
)
