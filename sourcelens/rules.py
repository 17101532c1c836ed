"""Brand rules: everything brand-specific is configuration, never code.

A ``BrandRules`` value is a small, fixed-size description (a few dozen strings)
that the column expressions in ``sourcelens.functions`` compile into native
Spark SQL expressions.  Its size does not grow with the data, so expressions
built from it are safe to inline into every task.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference behaviour for identical results,
# so they are stated here plainly, in their natural order.
# ---------------------------------------------------------------------------
# Host labels that mark a non-production host of an owned domain.
DEFAULT_NONPROD_PREFIXES = ("preprod", "staging", "stage", "dev", "test", "qa", "uat")
# Link path endings that are assets, not destinations.
DEFAULT_ASSET_EXT = (".jpg", ".jpeg", ".png", ".gif", ".svg", ".webp", ".ico", ".css", ".js",
                     ".woff", ".woff2", ".ttf", ".mp4", ".mov", ".webm", ".mp3")
# Host fragments of CDNs / trackers (matched as substrings of the host).
DEFAULT_ASSET_HOSTS = ("gstatic.com", "googlesyndication.com", "doubleclick.net", "google-analytics.com",
                       "googletagmanager.com", "fls-na.amazon.com", "redditstatic.com")
# App-store hosts: owned only when the URL carries an owned app id.
DEFAULT_APP_STORE_HOSTS = ("apps.apple.com", "play.google.com")
# Marketplace listing: exact host plus a path marker.
DEFAULT_MARKETPLACE_HOST = "amazon.com"
DEFAULT_MARKETPLACE_MARKER = "/dp/"
# Price strings as written in text.
DEFAULT_PRICE_PATTERN = r"\$\s?\d{2,}"
# Page-cache time to live in days; entries older than twice this are evicted.
CACHE_TTL_DAYS = 7
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class BrandRules:
    brand: str
    owned_domains: tuple[str, ...]
    competitor_domains: tuple[str, ...] = ()
    competitor_brands: tuple[str, ...] = ()
    owned_app_ids: tuple[str, ...] = ()
    # ordered (claim name, patterns) pairs; patterns are Python-style regexes on lower-cased text
    claim_patterns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    # claims whose presence means "describes the old product"; None = all claims
    stale_claims: tuple[str, ...] | None = None
    current_signal_patterns: tuple[str, ...] = ()
    price_pattern: str = DEFAULT_PRICE_PATTERN
    nonprod_prefixes: tuple[str, ...] = DEFAULT_NONPROD_PREFIXES
    asset_ext: tuple[str, ...] = DEFAULT_ASSET_EXT
    asset_hosts: tuple[str, ...] = DEFAULT_ASSET_HOSTS
    app_store_hosts: tuple[str, ...] = DEFAULT_APP_STORE_HOSTS
    marketplace_host: str = DEFAULT_MARKETPLACE_HOST
    marketplace_marker: str = DEFAULT_MARKETPLACE_MARKER
    # fallback narrative sentences
    stale_note_web: str = "Describes the old product as current."
    stale_note_answer: str = "Describes the old product."
    # brand matching: raw lower-cased substring (reference behaviour) or whole words
    word_boundary: bool = False
    extra: dict[str, Any] = field(default_factory=dict, compare=False, hash=False)

    # -- derived views -------------------------------------------------
    @property
    def brand_lower(self) -> str:
        return self.brand.lower()

    @property
    def claim_names(self) -> list[str]:
        return [name for name, _ in self.claim_patterns]

    @property
    def stale_claim_names(self) -> list[str]:
        return list(self.stale_claims) if self.stale_claims is not None else self.claim_names

    def mentions_note(self) -> str:
        return f"Mentions {self.brand}."

    def no_mention_note(self) -> str:
        return f"No clear mention of {self.brand}."

    def with_(self, **kw) -> "BrandRules":
        return replace(self, **kw)

    # -- loading -------------------------------------------------------
    @staticmethod
    def from_dict(d: dict) -> "BrandRules":
        claims = d.get("claim_patterns") or {}
        kw: dict[str, Any] = {
            "brand": d["brand"],
            "owned_domains": tuple(d.get("owned_domains", ())),
            "competitor_domains": tuple(d.get("competitor_domains", ())),
            "competitor_brands": tuple(d.get("competitor_brands", ())),
            "owned_app_ids": tuple(d.get("owned_app_ids", ())),
            "claim_patterns": tuple((k, tuple(v)) for k, v in claims.items()),
            "current_signal_patterns": tuple(d.get("current_signal_patterns", ())),
        }
        if d.get("stale_claims") is not None:
            kw["stale_claims"] = tuple(d["stale_claims"])
        for key in ("price_pattern", "marketplace_host", "marketplace_marker", "stale_note_web",
                    "stale_note_answer", "word_boundary"):
            if key in d:
                kw[key] = d[key]
        for key in ("nonprod_prefixes", "asset_ext", "asset_hosts", "app_store_hosts"):
            if key in d:
                kw[key] = tuple(d[key])
        return BrandRules(**kw)

    @staticmethod
    def from_json(path: str | Path) -> "BrandRules":
        return BrandRules.from_dict(json.loads(Path(path).read_text()))
