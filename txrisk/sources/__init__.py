"""Where messages and tables come from."""
