"""Assigning a business's tag string to one main category."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Main category -> tags, in the order in which the rules apply.
TAXONOMY: dict[str, tuple[str, ...]] = {
    "Food & Dining": (
        "Restaurants", "Food", "Nightlife", "Bars", "Sandwiches", "American (Traditional)", "Pizza",
        "Coffee & Tea", "Fast Food", "Breakfast & Brunch", "American (New)", "Burgers", "Mexican",
        "Italian", "Specialty Food", "Seafood", "Desserts", "Chinese", "Bakeries", "Salad",
        "Chicken Wings", "Cafes", "Dumplings", "Pita", "Somali", "Hakka", "Cucina campana", "Beer Hall",
        "Donburi", "Tonkatsu", "Lahmacun", "Cheese Tasting Classes",
    ),
    "Shopping & Retail": (
        "Shopping", "Home & Garden", "Fashion", "Grocery", "Bike Shop", "Concept Shops",
        "Ceremonial Clothing", "Props",
    ),
    "Beauty & Spas": ("Beauty & Spas", "Hair Salons", "Nail Salons", "Hair Removal", "Foot Care"),
    "Home & Local Services": (
        "Home Services", "Local Services", "Real Estate", "Pets", "Homeless Shelters",
        "Fire Departments", "Veterans Organizations", "Sauna Installation & Repair", "Water Suppliers",
        "Natural Gas Suppliers", "Housing Cooperatives", "Metal Detector Services",
    ),
    "Health & Medical": (
        "Health & Medical", "Doctors", "Nephrologists", "Otologists", "Infectious Disease Specialists",
        "Hospitalists", "Sperm Clinic", "Storefront Clinics", "Osteopaths", "Animal Assisted Therapy",
        "Mohels", "Faith-based Crisis Pregnancy Centers",
    ),
    "Automotive": ("Automotive", "Auto Repair"),
    "Arts, Entertainment & Events": (
        "Arts & Entertainment", "Event Planning & Services", "Carousels", "Art Consultants",
        "Art Installation", "Rodeo", "Experiences", "General Festivals", "Silent Disco",
        "Outdoor Movies", "Trade Fairs", "Karaoke Rental",
    ),
    "Active Life & Fitness": (
        "Active Life", "Fitness & Instruction", "Sledding", "Bocce Ball", "Ski Schools",
        "Kiteboarding", "Bicycle Paths", "Cheerleading", "Fencing Clubs", "Bubble Soccer",
        "Sport Equipment Hire",
    ),
    "Travel & Hospitality": ("Hotels & Travel", "Hotels", "Ferries", "Hotel bar"),
    "Education & Professional Services": (
        "Professional Services", "Waldorf Schools", "Vocal Coach", "Sports Psychologists",
        "Kitchen Incubators", "Circus Schools", "Calligraphy",
    ),
}


def rules_of(taxonomy: dict[str, tuple[str, ...]]) -> list[tuple[str, str]]:
    """(tag, main category) pairs in rule order."""
    return [(tag, group) for group, tags in taxonomy.items() for tag in tags]


def category_of(tags: Column, rules: Iterable[tuple[str, str]], default: str = "Other") -> Column:
    """Main category of a tag string: a rule matches as a case-sensitive substring and the last match wins.

    One flat CASE whose first branch is the last rule, so evaluation stops at the winner.
    """
    ordered = list(rules)[::-1]
    if not ordered:
        return F.lit(default)
    tag, group = ordered[0]
    choice = F.when(tags.contains(tag), group)
    for tag, group in ordered[1:]:
        choice = choice.when(tags.contains(tag), group)
    return choice.otherwise(default)


def assign_category(
    df: DataFrame,
    col: str = "categories",
    rules: Iterable[tuple[str, str]] | None = None,
    default: str = "Other",
    out: str = "main_category",
) -> DataFrame:
    """Add the main category of each row; the rules default to `TAXONOMY`."""
    return df.withColumn(out, category_of(F.col(col), rules_of(TAXONOMY) if rules is None else rules, default))
