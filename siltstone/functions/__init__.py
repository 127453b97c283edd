from siltstone.functions.dates import AsOf, Calendar, whole_years
from siltstone.functions.keys import surrogate_key
from siltstone.functions.text import blank_to_null, lower_text, title_text, upper_code

__all__ = [
    "AsOf",
    "Calendar",
    "blank_to_null",
    "lower_text",
    "surrogate_key",
    "title_text",
    "upper_code",
    "whole_years",
]
