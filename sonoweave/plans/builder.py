"""Control text with chosen extractors and options."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from sonoweave.functions.zscore import PAUSE_LEVELS
from sonoweave.operators import compose, controls


@dataclass(frozen=True)
class Options:
    """What the extractors and the composition can be told."""

    number_control: bool = False
    max_controls_per_clause: int | None = None
    pause_levels: Sequence[tuple[str, float | None]] = PAUSE_LEVELS
    emphasis_threshold: float = 1.0
    w_energy: float = 0.4
    w_duration: float = 0.3
    w_pitch: float = 0.3
    min_confidence: float = 0.3
    max_emotions: int = 2


@dataclass(frozen=True)
class Inputs:
    """The tables of a run: words with times (or listed rows); language and style; statistics; and, if there are any, frames and emotion scores."""

    words: DataFrame
    about: DataFrame
    stats: DataFrame
    frames: DataFrame | None = None
    scores: DataFrame | None = None


Extractor = Callable[[Inputs, Options], DataFrame]

#: Built-in extractors by type.
BUILT_IN: dict[str, Extractor] = {
    "style": lambda x, o: controls.style_controls(x.words, x.about),
    "break": lambda x, o: controls.pause_controls(x.words, o.number_control, o.pause_levels),
    "speed": lambda x, o: controls.speed_controls(x.words, x.about, x.stats, o.number_control),
    "volume": lambda x, o: controls.volume_controls(x.words, x.frames, x.about, x.stats, o.number_control),
    "pitch": lambda x, o: controls.pitch_controls(x.words, x.frames, o.number_control),
    "emphasis": lambda x, o: controls.emphasis_controls(
        x.words, x.frames, x.about, x.stats, o.number_control, o.emphasis_threshold, w_energy=o.w_energy, w_duration=o.w_duration, w_pitch=o.w_pitch
    ),
    "emotion": lambda x, o: controls.emotion_controls(x.words, x.scores, o.min_confidence, o.max_emotions),
}
NEEDS_FRAMES, NEEDS_SCORES = ("volume", "pitch", "emphasis"), ("emotion",)


class ControlBuilder:
    """Extractors in order; adding a type again replaces it in its place."""

    def __init__(self, options: Options | None = None, kinds: Sequence[str] = tuple(BUILT_IN)):
        self.options = options or Options()
        self.extractors: dict[str, Extractor] = {k: BUILT_IN[k] for k in kinds}

    def add_extractor(self, kind: str, extractor: Extractor) -> ControlBuilder:
        self.extractors[kind] = extractor
        return self

    def _missing(self, inputs: Inputs) -> list[str]:
        built_in = [k for k, f in self.extractors.items() if f is BUILT_IN.get(k)]
        return [k for k in built_in if k in NEEDS_FRAMES and inputs.frames is None or k in NEEDS_SCORES and inputs.scores is None]

    def controls(self, inputs: Inputs) -> DataFrame:
        """All controls, limited per clause.  A built-in extractor whose table is missing is an error; leave it out by ``kinds``."""
        missing = self._missing(inputs)
        if missing:
            raise ValueError(f"no table for the extractors {', '.join(missing)}")
        registry = compose.Registry()
        for kind, extractor in self.extractors.items():
            registry.add(kind, lambda extractor=extractor: extractor(inputs, self.options))
        return compose.limit_per_clause(registry.collect(), inputs.words, self.options.max_controls_per_clause)

    def build(self, inputs: Inputs) -> DataFrame:
        """``utt_id, text`` with the controls as tags."""
        return compose.control_text(inputs.words, self.controls(inputs))
