"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from .text import strip, is_in, replace_placeholders  # noqa: F401
from .numeric import coerce_number  # noqa: F401
from .dates import parse_sales_date, date_key_of  # noqa: F401
from .money import gross_amount, net_amount, money  # noqa: F401
