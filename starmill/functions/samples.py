"""The catalogue sample sales are drawn from, made up for this library."""

FIRST_DAY = "2024-01-01"
DAYS = 730

CUSTOMER_NAMES = [
    "Ada Quill", "Bram Osei", "Cleo Varga", "Dario Lindt", "Esme Tanaka", "Farid Novak", "Greta Holm",
    "Hugo Salas", "Ines Okoro", "Jonas Petit", "Kira Doyle", "Lorenz Haddad", "Mina Castell", "Nils Arendt",
]

# Share of sales in percent, and cities, per country.
COUNTRIES = {
    "Portugal": (28, ["Porto", "Braga"]),
    "Kenya": (22, ["Nairobi", "Mombasa", "Kisumu"]),
    "Canada": (20, ["Halifax", "Regina"]),
    "France": (16, ["Nantes", "Lille", "Dijon"]),
    "Algeria": (14, ["Annaba", "Setif"]),
}

# Share of sales in percent per discount.
DISCOUNTS = {0: 72, 5: 14, 12: 9, 25: 5}

# Product, category, subcategory, brand.
PRODUCTS = [
    ("Folding Kayak", "Outdoors", "Water", "Tern"),
    ("Trail Lantern", "Outdoors", "Camping", "Tern"),
    ("Walnut Desk Lamp", "Living", "Lighting", "Oakline"),
    ("Linen Throw", "Living", "Textiles", "Oakline"),
    ("Cast Iron Pan", "Kitchen", "Cookware", "Ferro"),
    ("Pour-over Set", "Kitchen", "Coffee", "Brava"),
    ("Field Recorder", "Audio", "Recording", "Sonde"),
    ("Desk Speaker", "Audio", "Speakers", "Sonde"),
    ("Ink Set", "Studio", "Drawing", "Marlow"),
    ("Cutting Mat", "Studio", "Tools", "Marlow"),
    ("Rain Shell", "Clothing", "Jackets", "Fjell"),
]
