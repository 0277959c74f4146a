"""Registered queries over the driver's test tables (stand-ins for the reference's data).

Importing this package registers every query; see ``registry.QUERIES`` / ``ORACLE``.
"""

from . import registry  # noqa: F401
from . import cashflow  # noqa: F401
from . import descriptive  # noqa: F401
from . import tabular  # noqa: F401
from . import text  # noqa: F401
from . import models  # noqa: F401
from . import files_io  # noqa: F401
