"""Thresholds of the site filter and of the call comparison."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """The defaults of the filter and caller options."""

    extend: int = 300
    bin_size: int = 50_000_000
    map_ratio: float = 0.5
    concord_window: int = 550
    concord_ratio: float = 0.55
    min_clips: int = 3
    min_discordant: int = 6
    min_clip_length: int = 9
    min_mapq: int = 20
    discordant_distance: int = 2000
    near_site: int = 50
    peak_bin: int = 15
    max_tsd: int = 50
    min_tsd: int = -20
    match_margin: int = 100
    min_ram: int = 3
    ram_cutoff: int = 6
    min_acr: int = 2
    min_acrr: float = 0.4
    min_out_conf: int = 5
    gap_cutoff: int = 500
    mode: str = "ra"
    no_clipped: bool = False
    exo: bool = False

    @property
    def oneside_ram(self) -> bool:
        return self.exo or self.mode == "va"

    @property
    def merge_family(self) -> bool:
        return not (self.exo or self.mode == "va")

    @property
    def stringent_pair(self) -> bool:
        return self.mode == "um"
