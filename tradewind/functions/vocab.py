"""Vocabularies and texts that results are compared on."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# They must equal the published data model for right results.
# ---------------------------------------------------------------------------
VALID_EVENTS = [
    "page_view", "product_view", "add_to_cart", "remove_from_cart",
    "add_to_wishlist", "checkout", "purchase",
]
NON_REVENUE_STATUS = ["Cancelled", "Returned"]
PAYMENT_METHODS = ["UPI", "Credit Card", "Debit Card", "Cash on Delivery", "Net Banking", "Wallet", "EMI"]
DEVICES = ["Mobile App", "Mobile Web", "Desktop"]
TRAFFIC_SOURCES = ["Organic Search", "Paid Search", "Social Media", "Referral", "Email", "Direct"]

# city, latitude, longitude
CITY_COORDINATES = [
    ("Mumbai", 19.08, 72.88), ("Delhi", 28.61, 77.21), ("Bengaluru", 12.97, 77.59),
    ("Hyderabad", 17.39, 78.49), ("Chennai", 13.08, 80.27), ("Kolkata", 22.57, 88.36),
    ("Pune", 18.52, 73.86), ("Ahmedabad", 23.02, 72.57), ("Thane", 19.22, 72.98),
    ("Gurugram", 28.46, 77.03), ("Noida", 28.54, 77.39), ("Jaipur", 26.91, 75.79),
    ("Lucknow", 26.85, 80.95), ("Surat", 21.17, 72.83), ("Chandigarh", 30.73, 76.78),
    ("Indore", 22.72, 75.86), ("Bhopal", 23.26, 77.41), ("Nagpur", 21.15, 79.09),
    ("Kochi", 9.93, 76.27), ("Coimbatore", 11.02, 76.96), ("Visakhapatnam", 17.69, 83.22),
    ("Vadodara", 22.31, 73.18), ("Patna", 25.59, 85.14), ("Bhubaneswar", 20.30, 85.82),
    ("Guwahati", 26.14, 91.74), ("Dehradun", 30.32, 78.03), ("Ranchi", 23.34, 85.31),
    ("Mysuru", 12.30, 76.64),
]

# name, month, first day, length in days
SALE_EVENTS = [
    ("Republic Day Sale", 1, 20, 5),
    ("Holi Sale", 3, 10, 3),
    ("Summer Sale", 5, 15, 4),
    ("End of Season Sale", 6, 20, 7),
    ("Independence Day Sale", 8, 12, 5),
    ("Big Festive Sale", 10, 3, 8),
    ("Diwali Dhamaka", 10, 25, 7),
    ("Black Friday", 11, 25, 4),
    ("Year End Sale", 12, 24, 8),
]

SEGMENT_ACTIONS = {
    "Champions": "Reward them: early access to sales, loyalty tier upgrades, referral programme.",
    "Loyal Customers": "Up-sell premium products and bundles; invite to membership programme.",
    "Potential Loyalists": "Personalised recommendations and a 2nd-purchase coupon to build habit.",
    "New & Promising": "Onboarding journey, welcome offers and category discovery e-mails.",
    "Needs Attention": "Time-limited offers on favourite categories to re-ignite interest.",
    "At Risk": "Win-back campaign: personalised discount + 'we miss you' push notification.",
    "About to Sleep": "Share bestsellers and limited-time deals before they lapse completely.",
    "Can't Lose Them": "High-value but lapsed: personal outreach, VIP win-back offer, feedback survey.",
    "Hibernating": "Low-cost reactivation (e-mail/app push) during big sale events only.",
    "Lost": "Exclude from paid campaigns; include in seasonal mass mailers.",
    "Prospects": "Browsed but never bought: retarget with first-order discount and free shipping.",
}

FEATURE_LABELS = {
    "recency_days": "Days since last order",
    "frequency": "Number of orders",
    "monetary": "Total spend",
    "aov": "Average order value",
    "tenure_days": "Customer tenure",
    "orders_90d": "Orders in last 90 days",
    "orders_prev_90d": "Orders in previous 90 days",
    "spend_90d": "Spend in last 90 days",
    "sessions_30d": "Sessions in last 30 days",
    "sessions_90d": "Sessions in last 90 days",
    "days_since_last_session": "Days since last visit",
    "cart_abandon_rate": "Cart abandonment rate",
    "avg_discount_pct": "Average discount %",
    "return_rate": "Return rate",
    "cancel_rate": "Cancellation rate",
    "category_diversity": "Categories purchased",
    "cod_share": "Cash-on-delivery share",
    "age": "Age",
    "city_tier": "City tier",
}

REASON_KNOWN = "Because you shop "
REASON_GENERIC = "Customers like you also bought this"
REASON_POPULAR = "Trending best-seller"
