"""Column expressions and the small vectorised helpers behind them."""
