"""DataFrame operators: extraction, paging, quality, keyed folds and work lists."""
