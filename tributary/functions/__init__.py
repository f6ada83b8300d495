"""Column builders (scalar functions).  All stay JVM-side and inside
whole-stage code generation; none is a Python UDF."""

from tributary.functions.dates import *  # noqa: F401,F403
from tributary.functions.numeric import *  # noqa: F401,F403
from tributary.functions.text import *  # noqa: F401,F403
from tributary.functions.geo import *  # noqa: F401,F403
