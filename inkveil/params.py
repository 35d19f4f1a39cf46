"""Rules and tuning values. Everything the engine looks for is data held here, never code."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, replace

# The default rule lists and regions every result depends on.
REDACT_LABELS = (
    "Nome:", "CPF:", "RG:", "Reg. Clínico:", "Registro Clínico:", "Convênio:", "Convenio:",
    "Responsável:", "Responsavel:", "Solicitante:", "Médico Responsável:", "Medico Responsavel:",
    "Idade:", "CRM:", "Médico:",
)
KEEP_LABELS = (
    "Sexo:", "Data:", "Hora:", "Data de Nascimento:", "Frequência cardíaca:", "Intervalo PR:",
    "Duração QRS:", "Intervalo QT/QTc:", "Eixo P-QRS-T:", "Interpretação:",
)
REGISTER_TOKENS = ("CRM", "CRM:", "crm")
PAGE1_REGIONS = ((0.35, 0.90, 0.65, 0.95), (50, 50, 200, 80), (300, 100, 500, 130))
PAGE2_REGIONS = (
    (0.02, 0.10, 0.12, 0.17), (0.13, 0.10, 0.18, 0.135), (0.40, 0.94, 0.98, 0.97),
    (0.88, 0.85, 0.96, 0.92), (100, 200, 400, 250), (50, 300, 300, 350),
)

Region = tuple[float, float, float, float]


@dataclass(frozen=True)
class RuleSet:
    """What to look for: labels, register tokens and fixed page regions."""

    redact_labels: tuple[str, ...] = REDACT_LABELS
    keep_labels: tuple[str, ...] = KEEP_LABELS
    register_tokens: tuple[str, ...] = REGISTER_TOKENS
    page1_regions: tuple[Region, ...] = PAGE1_REGIONS
    page2_regions: tuple[Region, ...] = PAGE2_REGIONS

    @property
    def search_terms(self) -> tuple[str, ...]:
        """Register tokens as case-insensitive search strings, without repeats."""
        return tuple(dict.fromkeys(t.lower() for t in self.register_tokens))


@dataclass(frozen=True)
class RuleParams:
    """Distances in points. The defaults are the reference's code defaults."""

    line_tolerance: float = 1.0
    prevline_tolerance: float = 10.0
    padding: float = 1.0
    signature_x_slack: float = 50.0
    dpi: int = 220
    output_bucket: str = "anonymized"
    # Pages with more words than this are cut into blocks of block_words instead of being folded whole.
    page_split_rows: int = 2048
    block_words: int = 1024
    # Cells of a page in which more words than this meet boxes are dealt to parts.
    dense_rows: int = 20_000
    # Labels of several words match words that follow each other in a line. Off, they match nothing.
    multiword_labels: bool = False

    def __post_init__(self) -> None:
        if not 0 <= self.line_tolerance < 2**25:
            raise ValueError("line_tolerance must be at least 0 and less than 2**25")

    @classmethod
    def profile(cls, name: str) -> RuleParams:
        return replace(cls(), **PROFILES[name])

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> RuleParams:
        """Defaults overridden by the environment variables in ENV_FIELDS."""
        env = os.environ if env is None else env
        found = {f: cast(env[name]) for name, (f, cast) in ENV_FIELDS.items() if name in env}
        return replace(cls(), **found)


# The deployed and the documented tuning profiles.
PROFILES: dict[str, dict[str, float]] = {
    "default": {},
    "deployed": {"line_tolerance": 5.0, "prevline_tolerance": 20.0, "padding": 2.0, "dpi": 150},
    "documented": {"line_tolerance": 3.0, "prevline_tolerance": 10.0, "padding": 2.0, "dpi": 150},
}

# The names of the environment variables that deployments set.
ENV_FIELDS = {
    "LINE_TOLERANCE": ("line_tolerance", float),
    "PREVLINE_TOLERANCE": ("prevline_tolerance", float),
    "PADDING": ("padding", float),
    "DPI_PAGE2_RENDER": ("dpi", int),
    "OUTPUT_BUCKET": ("output_bucket", str),
}
