"""Model layers (staging → intermediate → core → analytics) and their build."""
