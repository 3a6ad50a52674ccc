"""Column functions: text, prices, URLs, HTML fragments and time stamps."""
