"""Named tables of each subject area.  Importing this package registers them all."""

from stratamart.plans import (  # noqa: F401
    coupons,
    helpers,
    logistics_dim,
    logistics_dwd,
    logistics_dws,
    logistics_ads,
    product_360,
    product_macro,
    realtime,
    refund,
    shop_ads,
    shop_dim,
    shop_dwd,
    shop_dws,
    traffic,
)
