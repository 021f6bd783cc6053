from sparkmart.functions.casting import lenient_int, parse_date, try_double, try_int
from sparkmart.functions.partition import key_partition
from sparkmart.functions.rules import band, first_match, masked
from sparkmart.functions.text import format_phone, full_name, title_case

__all__ = ["lenient_int", "try_double", "try_int", "parse_date", "format_phone",
           "title_case", "full_name", "band", "first_match", "masked", "key_partition"]
