"""Reading survey forms, dimension tables and form rules; publishing results."""
