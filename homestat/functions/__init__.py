"""Column functions: pure expressions that stay inside whole-stage codegen."""

from homestat.functions.listing import (  # noqa: F401
    area_tier,
    cast_numeric,
    derive_ppm,
    normalize_text,
    price_tier,
    tier,
)
from homestat.functions.parse import (  # noqa: F401
    abs_url,
    derive_id,
    parse_area,
    parse_category,
    parse_location,
    parse_price,
    truncate_title,
)
