"""Name tables shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Country spellings and the name they are counted under.
COUNTRY_NAMES = {
    "Brasil": "Brazil",
    "United States": "United States of America",
    "Deutschland": "Germany",
}

# Lower-case browser name and the platform it stands for; all others are OTHER_PLATFORM.
BROWSER_PLATFORMS = {
    "safari": "iOS",
    "chrome": "Android",
    "firefox": "Desktop",
    "ie": "Desktop",
}
OTHER_PLATFORM = "Web"

# Funnel step names.
REGISTRATION_STEP = "New User Registration"
SHOPPING_STEPS = {"product": "Product View", "cart": "Add to Cart", "purchase": "Purchase"}

PLATFORMS = sorted({*BROWSER_PLATFORMS.values(), OTHER_PLATFORM})


def platform_code(browser: Column) -> Column:
    """Index into PLATFORMS, a fixed-width stand-in for the name inside aggregates."""
    codes = F.create_map(
        *[F.lit(item) for name, platform in BROWSER_PLATFORMS.items() for item in (name, PLATFORMS.index(platform))]
    )
    return F.coalesce(F.try_element_at(codes, F.lower(browser)), F.lit(PLATFORMS.index(OTHER_PLATFORM)))


def platform_browser(code: Column) -> Column:
    """A browser that counts as the platform; any other name counts as OTHER_PLATFORM."""
    browsers = {platform: name for name, platform in BROWSER_PLATFORMS.items()}
    return F.element_at(F.array(*[F.lit(browsers.get(name, "other")) for name in PLATFORMS]), code + 1)


def platform_name(code: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in PLATFORMS]), code + 1)
