"""The layouts and the job the registered queries use: what a photo or clip shows."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum

from glossa import JobConfig


class Mood(str, Enum):
    FESTIVE = "FESTIVE"
    LIVELY = "LIVELY"
    CALM = "CALM"
    GRIM = "GRIM"


@dataclass
class Spot:
    country: str | None = None
    city: str | None = None


@dataclass
class Scene:
    caption: str | None = field(metadata={"description": "One sentence on what is to be seen."})
    score: float | None = field(metadata={"description": "How sharp the picture is."})
    mood: Mood = Mood.CALM
    objects: list[str] = field(default_factory=list)
    spot: Spot | None = None
    indoors: bool = False
    lang: str = "und"


@dataclass
class Note:
    caption: str
    lang: str = "und"
    indoors: bool | None = None


@dataclass
class Prior:
    mood: Mood | None
    indoors: bool | None
    quality: int
    caption: str | None


PROMPT = "Describe the media."
TEMPLATE = "Post {post_id_and_prior_json} with {{braces}}\nrow {row_metadata_json}\nat {canonical_post_url}"

JOB = JobConfig(
    analysis=Scene,
    prompt=PROMPT,
    primary_model="primary",
    fallback_model="fallback",
    stop_on_primary_daily_quota=False,
)
