"""Writers. Files are sized by AQE, so no writer funnels a table through one task."""
