"""Where documents come from: files, notifications, and views over tables."""
