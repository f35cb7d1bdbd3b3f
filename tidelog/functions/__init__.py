from tidelog.functions.events import effective_key, image_value, op_name, order_key
from tidelog.functions.text import clean, email_domain, full_name, synthetic_email
from tidelog.functions.time import event_date, event_time

__all__ = [
    "clean",
    "effective_key",
    "email_domain",
    "event_date",
    "event_time",
    "full_name",
    "image_value",
    "op_name",
    "order_key",
    "synthetic_email",
]
