"""What differs between the ad channels, in one place."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from adlog.functions import scalars


@dataclass(frozen=True)
class Channel:
    """Vocabulary and report shape of one ad channel."""

    name: str
    event_source: str
    devices: dict[str, str] = field(hash=False)
    keyword: Callable[[Column], Column]
    has_impression_share: bool


# Report and tag vocabularies of the ad platforms.
SEARCH_DEVICES = {
    "Computers": "dt",
    "Tablets with full browsers": "dt",
    "Mobile devices with full browsers": "mb",
}
BING_DEVICES = {
    "Computer": "dt",
    "Tablet": "dt",
    "Smartphone": "mb",
}

SEARCH = Channel(
    name="search",
    event_source="Google",
    devices=SEARCH_DEVICES,
    keyword=scalars.normalize_keyword,
    has_impression_share=True,
)
BING = Channel(
    name="bing",
    event_source="Bing",
    devices=BING_DEVICES,
    keyword=scalars.normalize_keyword_bing,
    has_impression_share=False,
)
