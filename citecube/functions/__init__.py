"""Column-expression builders (JVM-side, whole-stage-codegen friendly)."""

from .text import (clean_key, decade, drop_placeholder, join_list, safe_int, last_parseable_int,
                   split_list, trim_ctl, venue_string, acm_venue_string, volume_issue)

__all__ = ["clean_key", "decade", "drop_placeholder", "join_list", "safe_int",
           "last_parseable_int", "split_list", "trim_ctl", "venue_string",
           "acm_venue_string", "volume_issue"]
