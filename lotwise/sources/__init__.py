"""Where listings come from and the messages they travel in."""
