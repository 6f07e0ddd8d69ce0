"""Configuration presets.

Two presets reproduce the two variants of the original analysis: ``MAIN``
(step-by-step variant) and ``REFS`` (compact variant). They differ in state
labels, cluster grid, denominators, sign conventions and offsets; every
operator takes one config object instead of having two code paths.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


# ---------------------------------------------------------------------------
# Fixed values that must equal the original analysis for identical results:
# life-cycle state labels, cluster labels and product names. Course slugs are
# a parameter of the education store.
# ---------------------------------------------------------------------------

# Life-cycle state labels, in rule order: curious, loyal, regained, reborn,
# tourist, disenchanted, zombie.
LIFECYCLE_LABELS_MAIN = (
    "01-CURIOSO", "02-FIEL", "02-RECONQUISTADO", "02-RENASCIDO",
    "03-TURISTA", "04-DESENCANTADO", "05-ZUMBI",
)
LIFECYCLE_LABELS_REFS = (
    "01-CURIOSO", "02-FIEL", "02-RECONQUISTADO", "02-REBORN",
    "03-TURISTA", "04-DESENCANTADA", "05-ZUMBI",
)

# Frequency-value cluster labels: lurker, lazy, potential, undecided,
# hard-working, hyper, efficient.
RFV_LABELS_MAIN = (
    "00.LURKER", "01.PREGUIÇOSO", "20.POTENCIAL", "11.INDECISO",
    "21.ESFORÇADO", "12.HYPER", "22.EFICIENTE",
)
RFV_LABELS_REFS = (
    "00-LURKER", "01-PREGUIÇOSO", "20-POTENCIAL", "11-INDECISO",
    "21-ESFORÇADO", "12-HYPER", "22-EFICIENTE",
)

# Products and categories shared out in the transactional feature store of
# the original loyalty system (defaults; fixtures pass their own lists).
PRODUCT_NAMES_DEFAULT = (
    "ChatMessage", "Airflow Lover", "R Lover", "Resgatar Ponei",
    "Lista de presença", "Presença Streak", "Troca de Pontos StreamElements",
    "Reembolso: Troca de Pontos StreamElements",
)
PRODUCT_CATEGORIES_DEFAULT = ("rpg", "churn_model")

# Fill value for the categorical state columns before one-hot encoding.
NON_USER_MAIN = "Não-usuário"
NON_USER_REFS = "Nao-Usuario"

# Day-part bands in UTC hours (inclusive): morning 10-14, afternoon 15-21,
# night = hour > 21 or hour < 10.
DAYPART_MORNING = (10, 14)
DAYPART_AFTERNOON = (15, 21)


@dataclass(frozen=True)
class LifecycleCfg:
    labels: tuple = LIFECYCLE_LABELS_MAIN
    curious_max_first_age: int = 7      # first activity within the last 7 days
    recent_max_age: int = 7             # last activity within the last 7 days
    loyal_max_gap: int = 14             # gap to the previous active day
    regained_max_gap: int = 27          # 15..27 regained, >= 28 reborn
    tourist_max_age: int = 14           # 8..14
    disenchanted_max_age: int = 28      # 15..28, > 28 zombie
    lookback_days: int = 28             # frequency-value window

    @property
    def zombie(self) -> str:
        return self.labels[6]

    @property
    def loyal(self) -> str:
        return self.labels[1]


@dataclass(frozen=True)
class RfvCfg:
    variant: str = "main"               # "main" or "refs" rule grid
    labels: tuple = RFV_LABELS_MAIN


@dataclass(frozen=True)
class FeatureCfg:
    """Switches of the transactional / life-cycle / education stores."""
    variant: str = "main"
    windows: tuple = (7, 14, 28, 56)
    fractional_age: bool = False        # refs: fractional days to cutoff-1
    signed_negative_points: bool = False  # refs keeps negative points signed
    daypart_denominator: str = "distinct_tx"   # refs: "rows"
    product_denominator: str = "distinct_tx"   # refs: "rows" (fanned-out)
    products: tuple = PRODUCT_NAMES_DEFAULT
    categories: tuple = PRODUCT_CATEGORIES_DEFAULT
    courses: tuple = ()                 # pivoted course slugs (default: all of the register)
    course_fill_zero: bool = False      # refs fills untaken courses with 0
    fractional_edu_recency: bool = False
    lc_current_offset: int = 1          # snapshot read at cutoff - offset
    moving_average: bool = True         # own D7/D14 moving frequency (main)


@dataclass(frozen=True)
class Preset:
    name: str
    lifecycle: LifecycleCfg
    rfv: RfvCfg
    features: FeatureCfg

    def with_features(self, **kw) -> "Preset":
        return replace(self, features=replace(self.features, **kw))


MAIN = Preset(
    name="main",
    lifecycle=LifecycleCfg(labels=LIFECYCLE_LABELS_MAIN),
    rfv=RfvCfg(variant="main", labels=RFV_LABELS_MAIN),
    features=FeatureCfg(variant="main", lc_current_offset=0, moving_average=True),
)

REFS = Preset(
    name="refs",
    lifecycle=LifecycleCfg(labels=LIFECYCLE_LABELS_REFS),
    rfv=RfvCfg(variant="refs", labels=RFV_LABELS_REFS),
    features=FeatureCfg(
        variant="refs", fractional_age=True, signed_negative_points=True,
        daypart_denominator="rows", product_denominator="rows",
        course_fill_zero=True, fractional_edu_recency=True,
        lc_current_offset=1, moving_average=False,
    ),
)

PRESETS = {"main": MAIN, "refs": REFS}


def preset(name_or_preset) -> Preset:
    if isinstance(name_or_preset, Preset):
        return name_or_preset
    return PRESETS[name_or_preset]


# Keep ``field`` importable for subclasses that extend the configs.
__all__ = ["LifecycleCfg", "RfvCfg", "FeatureCfg", "Preset", "MAIN", "REFS",
           "PRESETS", "preset", "field"]
