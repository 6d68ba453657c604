from tabforge.functions.nullsafe import (  # noqa: F401
    flag, eq_flag, ne_flag, gt_flag, isin_flag, qcol, safe_name,
)
from tabforge.functions.numeric import (  # noqa: F401
    boxcox1p, boxcox, round_half_up_to, log1p, expm1,
)
