"""Column helpers and the building blocks that keep hot groups splittable."""
