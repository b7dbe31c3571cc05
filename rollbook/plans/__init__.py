"""Product plans: attendance staging and gold, MBR snapshot, bronze/silver transforms."""
