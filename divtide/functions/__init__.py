from divtide.functions.scalars import (
    as_date,
    as_double,
    as_long,
    blank_null_tokens,
    clean_text,
    day,
    frequency_label,
    lifecycle_stage,
    person_message,
)

__all__ = [
    "as_date",
    "as_double",
    "as_long",
    "blank_null_tokens",
    "clean_text",
    "day",
    "frequency_label",
    "lifecycle_stage",
    "person_message",
]
