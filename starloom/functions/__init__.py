from .columns import (
    blank_tokens,
    calendar_key,
    changed,
    in_window,
    parse_flag,
    share_of,
    typed_null,
)

__all__ = ["blank_tokens", "calendar_key", "changed", "in_window", "parse_flag", "share_of", "typed_null"]
