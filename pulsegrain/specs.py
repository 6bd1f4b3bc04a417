"""What a deployment declares: pipelines, counters, time rules. Checked when built, not when run."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column

from pulsegrain.functions.times import LOCAL_ZONE
from pulsegrain.functions.variants import ANY, steps
from pulsegrain.operators.reshape import Layouts

# Names of the time rules and counter kinds as configurations spell them.
TIME_KINDS = ("RFC2822", "ISO8601", "EpochMilli", "EpochSeconds")
COUNTER_KINDS = ("u32", "u64")


class BadSpec(ValueError):
    """A declaration that cannot work."""


@dataclass(frozen=True)
class TimeRule:
    """Where a row's own time is and how to read it."""

    path: str
    kind: str
    # Of local times, which name none.
    zone: str = LOCAL_ZONE

    def __post_init__(self):
        if self.kind not in TIME_KINDS:
            raise BadSpec(f"unknown time rule {self.kind!r}; one of {', '.join(TIME_KINDS)}")
        steps(self.path)


@dataclass(frozen=True)
class KeyPart:
    """One part of a counter key: a path into the row or a constant."""

    path: str | None = None
    constant: str | None = None

    def __post_init__(self):
        if (self.path is None) == (self.constant is None):
            raise BadSpec("a key part is either a path or a constant")
        if self.path is not None:
            steps(self.path)


@dataclass(frozen=True)
class CounterSpec:
    """A cumulative counter inside a row."""

    key: tuple[KeyPart, ...]
    kind: str
    value: str
    match: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self):
        if self.kind not in COUNTER_KINDS:
            raise BadSpec(f"unknown counter type {self.kind!r}; one of {', '.join(COUNTER_KINDS)}")
        if not self.key:
            raise BadSpec("a counter needs at least one key part")
        parts = steps(self.value)
        if not parts or any(part == ANY or isinstance(part, int) for part in parts):
            raise BadSpec(f"a counter value must be a path of names: {self.value!r}")

    @property
    def entity(self) -> tuple[str | None, ...]:
        """The key with its constants blanked; counters that agree on it share one state row."""
        return tuple(part.path for part in self.key)

    @property
    def slot(self) -> tuple[str | None, ...]:
        """The constants of the key."""
        return tuple(part.constant for part in self.key)

    @property
    def slot_name(self) -> str:
        """The constants as one text, the name that a reading of this counter has in state."""
        return json.dumps(self.slot)


@dataclass(frozen=True)
class CounterSet:
    """All counters of one pipeline and the time rule they share."""

    time: TimeRule
    counters: tuple[CounterSpec, ...]

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> CounterSet:
        """Read the JSON form: ``timestamp-extractor`` and ``counters``."""
        time = config.get("timestamp-extractor")
        if time is None:
            raise BadSpec("counters need a timestamp-extractor")
        counters = []
        for item in config.get("counters") or ():
            key = tuple(
                KeyPart(path=part.get("jsonpath"), constant=None if "jsonpath" in part else part["constant"])
                for part in item["key"]
                if "jsonpath" in part or "constant" in part
            )
            counters.append(
                CounterSpec(key=key, kind=item["type"], value=item["value"]["jsonpath"], match=item.get("match", {}))
            )
        return cls(TimeRule(time["jsonpath"], time["timestamp-type"], time.get("zone", LOCAL_ZONE)), tuple(counters))

    def groups(self) -> list[list[CounterSpec]]:
        """Counters by shared entity; entities stand in an order that does not depend on that of the counters."""
        found: dict[tuple[str | None, ...], list[CounterSpec]] = {}
        for counter in self.counters:
            found.setdefault(counter.entity, []).append(counter)
        return [found[entity] for entity in sorted(found, key=lambda parts: [part or "" for part in parts])]


@dataclass(frozen=True)
class NormalizeConfig:
    """Limits of counter normalisation."""

    cutoff_ms: int = 30 * 60_000
    cache_age_ms: int = 15 * 60_000
    u32_limit: int = 10_000
    u64_limit: int = 10_000_000
    wrap_time_ms: int = 5 * 60_000
    # Streams: how often the readings of an entity are looked through for old ones, in processing time. Old is what the
    # stream's own time has left behind by more than the cache age.
    clean_every_ms: int = 7 * 86_400_000

    def __post_init__(self):
        if min(self.cutoff_ms, self.cache_age_ms, self.wrap_time_ms, self.clean_every_ms) < 0:
            raise BadSpec("times must not be negative")
        if not 0 <= self.u32_limit < 2**31 or not 0 <= self.u64_limit < 2**63:
            raise BadSpec("wrap limits must fit the signed type of the counter")


@dataclass(frozen=True)
class Pipeline:
    """One branch of the deployment.

    ``transform`` maps the document column (VARIANT) to its rows (ARRAY<VARIANT>), or is a ``reshape.Layouts``; None keeps
    the document as the only row. ``check`` may give a message that sends the whole document to the dead letters instead.
    """

    tag: str
    topic: str
    match: Mapping[str, Any] = field(default_factory=dict)
    transform: Callable[[Column], Column] | Layouts | None = None
    counters: CounterSet | None = None
    check: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class App:
    """A whole deployment. ``pre_transform`` maps document to document; NULL drops it silently. ``pre_check`` may give a message
    that sends the document to the dead letters before."""

    pipelines: Sequence[Pipeline]
    discard_topic: str = "discard"
    dlq_topic: str = "dlq"
    pre_transform: Callable[[Column], Column] | None = None
    pre_check: Callable[[Column], Column] | None = None
    normalize: NormalizeConfig = field(default_factory=NormalizeConfig)
    name: str = "pulsegrain"

    def __post_init__(self):
        tags = [pipeline.tag for pipeline in self.pipelines]
        if len(set(tags)) != len(tags):
            raise BadSpec("pipeline tags must differ")

    @property
    def topics(self) -> dict[str, str]:
        return {pipeline.tag: pipeline.topic for pipeline in self.pipelines}
