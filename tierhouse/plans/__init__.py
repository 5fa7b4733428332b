"""The bike-shop warehouse: silver and gold builders, rules and refresh."""
